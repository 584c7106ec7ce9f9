"""Benchmark decontamination: SimHash of item-sized windows, Hamming multi-index, exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .textkit import U, chunks, inner, mix, texts_of, windows, words_of

BITS = 128
BLOCKS = BITS // 8
RADIUS = 39  # of 128 bits; texts at similarity 0.8 differ in 19 +- 4
LOCAL = RADIUS // BLOCKS  # within RADIUS, some block differs in at most so many bits
_SALTS = mix(np.arange(1, 3, dtype=U) * U(0x632BE59BD9B4E019))
_NEAR = [[b for b in range(256) if bin(a ^ b).count("1") <= LOCAL] for a in range(256)]
_IS_NEAR = np.array([[b in near for b in range(256)] for near in map(set, _NEAR)])
_CELLS = 1 << 22  # windows times items looked at together
FEW = 256  # items of one length up to which their block values are compared one by one
_COUNT = np.array([bin(a).count("1") for a in range(256)], np.uint8)


def _bits(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle's 128-bit hash."""
    raw = np.stack([mix(shingles ^ s) for s in _SALTS], axis=1).view(np.uint8).reshape(len(shingles), BLOCKS)
    return np.unpackbits(raw, axis=1).astype(np.int32) * 2 - 1


def _fingerprints(shingles: np.ndarray, width: int) -> np.ndarray:
    """SimHash bytes of each run of ``width`` shingles; a repeated shingle weighs as often as it occurs."""
    sums = np.zeros((len(shingles) + 1, BITS), np.int32)
    np.cumsum(_bits(shingles), axis=0, out=sums[1:])
    return np.packbits(sums[width:] - sums[: len(sums) - width] > 0, axis=1)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater multiplicity, over all shingles of both."""
    keys, n = np.unique(a, return_counts=True)
    other, m = np.unique(b, return_counts=True)
    common, i, j = np.intersect1d(keys, other, assume_unique=True, return_indices=True)
    low = int(np.minimum(n[i], m[j]).sum()) if len(common) else 0
    return low / max(1, len(a) + len(b) - low)


class ItemIndex:
    """Benchmark items by length, with lists by block value for the Hamming search, and their shingles."""

    def __init__(self, ids: list, texts: list, width: int, least: float):
        self.width, self.least = width, least
        words = words_of(texts, full_lower=True, strip_punctuation=True)
        self.by_length: dict[int, list] = {}
        for k, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
            if b > a:
                self.by_length.setdefault(b - a, []).append((ids[k], windows(words.hash[a:b], min(width, b - a))))
        pairs = sorted((int(g), n) for n, items in self.by_length.items() for _, s in items for g in set(s.tolist()))
        self.known = np.array([g for g, _ in pairs], U)
        self.lengths_of = np.array([n for _, n in pairs], np.int64)
        self.short = sorted(n for n in self.by_length if n < width)
        self.prints = {n: np.concatenate([_fingerprints(s, len(s)) for _, s in items]) for n, items in self.by_length.items()}
        # per length and block: the items in order of the block's value, and where each value begins
        self.order = {n: np.argsort(p, axis=0, kind="stable").astype(np.int32) for n, p in self.prints.items()}
        self.begin = {n: np.stack([np.concatenate([[0], np.cumsum(np.bincount(p[:, b], minlength=256))]) for b in range(BLOCKS)]) for n, p in self.prints.items()}
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.known & U((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, shingles: np.ndarray) -> Iterator[tuple[int, int]]:
        """(position, item length) where a shingle of some item of that length stands."""
        at = np.flatnonzero(self.bitmap[(shingles & U((1 << 20) - 1)).astype(np.int64)])
        lo, hi = np.searchsorted(self.known, shingles[at], "left"), np.searchsorted(self.known, shingles[at], "right")
        for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
            for n in dict.fromkeys(self.lengths_of[a:b].tolist()):
                yield p, n

    def search(self, shingles: np.ndarray, n: int) -> Iterator[tuple[int, object, float]]:
        """(start, item, similarity) of windows of n words that reach the similarity, from their shingles."""
        w = min(len(shingles), max(1, n - min(self.width, n) + 1))
        prints = _fingerprints(shingles, w)
        own = self.prints[n]
        step = max(1, _CELLS // len(own))
        for at in range(0, len(prints), step):
            part = prints[at : at + step]
            for start, k in np.argwhere(self._near(part, n)).tolist():
                if int(_COUNT[part[start] ^ own[k]].sum()) <= RADIUS:
                    item, its = self.by_length[n][k]
                    s = weighted_similarity(shingles[at + start : at + start + w], its)
                    if s >= self.least:
                        yield at + start, item, s

    def _near(self, prints: np.ndarray, n: int) -> np.ndarray:
        """Which items of n words share a block with each print but for LOCAL bits: from the lists of the block values near its own, or one by one where items are few."""
        order, begin = self.order[n], self.begin[n]
        near = np.zeros((len(prints), len(order)), bool)
        if len(order) <= FEW:
            for b in range(BLOCKS):
                near |= _IS_NEAR[prints[:, b][:, None], self.prints[n][:, b][None, :]]
            return near
        for b in range(BLOCKS):
            for value in np.unique(prints[:, b]).tolist():
                lists = [order[begin[b, v] : begin[b, v + 1], b] for v in _NEAR[value] if begin[b, v] < begin[b, v + 1]]
                if lists:
                    near[np.ix_(np.flatnonzero(prints[:, b] == value), np.concatenate(lists))] = True
        return near

    def scan(self, texts: list) -> Iterator[tuple[int, object, int, int, float]]:
        """(text number, item, word position, windows, similarity): the best window per text and item."""
        words = words_of(texts, full_lower=True, strip_punctuation=True)
        best: dict[tuple[int, object], list] = {}

        def found(t: int, item: object, start: int, s: float) -> None:
            b = best.setdefault((t, item), [start, 0, -1.0])
            b[1] += 1
            if s > b[2]:
                b[0], b[2] = start, s

        first = words.first
        for width in sorted({self.width, *self.short}):
            all_windows = windows(words.hash, width)
            inside = inner(first, width)
            at = np.flatnonzero(inside)
            wanted: dict[tuple[int, int], list[int]] = {}
            for p, n in self.hits(all_windows[at]):
                if width == min(self.width, n):
                    p = int(at[p])
                    wanted.setdefault((int(np.searchsorted(first, p, "right")) - 1, n), []).append(p)
            for (t, n), hits in wanted.items():
                a, b = int(first[t]), int(first[t + 1])
                n_windows = b - a - width + 1  # shingles of the text
                w = min(n - width + 1, n_windows)  # shingles of a window
                starts = sorted({s for p in hits for s in range(max(a, p - w + 1), min(p, a + n_windows - w) + 1)})
                run = [starts[0], starts[0]]
                for s in [*starts[1:], None]:
                    if s is not None and s == run[1] + 1:
                        run[1] = s
                        continue
                    for start, item, sim in self.search(all_windows[run[0] : run[1] + w], n):
                        found(t, item, run[0] + start - a, sim)
                    run = [s, s]
        for (t, item), (start, n, s) in best.items():
            yield t, item, start, n, s


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = 5, least: float = 0.8, block_items: int = 20_000, with_key: bool = False) -> DataFrame:
    """Pairs of a document and a benchmark item that some item-sized window of it resembles.

    Words are lower-cased and stripped of ASCII punctuation.  A window has as
    many words as the item (a shorter document is one window).  Windows that
    share no shingle with an item of their length cannot be similar to one and
    are not fingerprinted; the others query the multi-index, whose blocks return
    every item within RADIUS, and a candidate counts if its multiset similarity
    on ``width``-word shingles (fewer words: the whole item) reaches ``least``.

    Items travel to the executors in blocks of at most block_items, one pass
    over the documents each, so what is broadcast stays bounded.  Null or empty
    texts and items match nothing; repeated items report once per item_id.

    Returns doc_id, item_id, start_word of the best window, n_windows that
    match, similarity and, if asked for, the md5 of the text as key.  Each row is judged
    by itself: rows that repeat an id, or have none, report one by one.
    """
    spark = docs.sparkSession
    items = Stages(spark, "items").keep(benchmark.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text"))
    n_blocks = max(1, -(-items.count() // block_items))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", (F.md5("text") if with_key else F.lit(None).cast("string")).alias("key"))
    out = None
    for k in range(n_blocks):
        block = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).orderBy("item_id", "text").toPandas()
        index = spark.sparkContext.broadcast(ItemIndex(block["item_id"].tolist(), block["text"].tolist(), width, least))

        def run(frames, index=index):
            for part in chunks(frames):
                ids, keys = part["doc_id"].tolist(), part["key"].tolist()
                found = [(ids[t], item, start, n, s, keys[t]) for t, item, start, n, s in index.value.scan(texts_of(part["text"]))]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "start_word", "n_windows", "similarity", "key"])

        part = rows.mapInPandas(run, "doc_id long, item_id long, start_word long, n_windows long, similarity double, key string")
        out = part if out is None else out.unionByName(part)
    return out if with_key else out.drop("key")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that resemble no benchmark item; each row is judged by its own text, whether its id repeats or is missing."""
    found = contaminated(docs, benchmark, with_key=True).select(F.col("doc_id").alias("_found"), F.col("key").alias("_key")).distinct()
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["_found"]) & (F.md5(docs["text"]) == found["_key"]), "left_anti")
