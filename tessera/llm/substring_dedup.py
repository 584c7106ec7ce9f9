"""Substring deduplication over a log-structured index of window fingerprints.

Every window of WINDOW words holds CORE-word windows at WINDOW - CORE + 1
places; the one with the least hash (the leftmost of equals) is its anchor.
Equal windows have equal anchors at equal offsets, so anchors alone are indexed,
about one in thirteen words.

The index is a log of immutable runs in a shared folder.  A run holds each anchor
hash once, with one place it stands at and whether it stands at more, in
buckets of the hash that are sorted inside.  A batch becomes a run of its own,
merge-joined bucket by bucket with the runs there are, which stay where they
lie; when runs have gathered, they are merged into one.  A manifest names the
live runs, so an index can be opened again.

Anchors at two places or more are hits; the windows around hits are then
verified by a 128-bit digest of all their words before anything is removed.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Stages, join_groups, make_text_file, read_latest
from .textkit import U, chunks, inner, texts_of, windows, words_of

CORE = 10
_POS = U((1 << 30) - 1)
_FLUSH = 1 << 24  # characters of text whose entries leave a worker together
_ENTRY = "h long, k1 long, k2 long, at int, many boolean, places array<int>"
_PACKED = "bucket long, d1 binary, d2 binary, k1 binary, k2 binary, at binary, many binary"


def text_key(text: Column) -> tuple[Column, Column]:
    """The 128 bits by which a text is known, as two columns."""
    hexed = F.md5(text)
    return tuple(F.conv(F.substring(hexed, at, 16), 16, -10).cast("long") for at in (1, 17))


def anchors(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, anchor position of each, core hashes) over the words of many texts."""
    core = windows(hashes, CORE)
    at = np.flatnonzero(inner(first, window))
    if not len(at):
        return at, at, core
    span = window - CORE + 1
    low = (core & ~_POS) | np.arange(len(core), dtype=U)
    have = 1
    while have * 2 <= span:
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    rest = span - have
    if rest:
        low = np.minimum(low[: len(low) - rest], low[rest:])
    return at, (low[at] & _POS).astype(np.int64), core


def _flushes(frames):
    """Lists of frame slices holding about _FLUSH characters together."""
    held, size = [], 0
    for part in chunks(frames):
        held.append(part)
        size += sum(len(t) for t in part["text"] if isinstance(t, str))
        if size >= _FLUSH:
            yield held
            held, size = [], 0
    if held:
        yield held


def _grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by the keys, the last first; which begin a group of equals in it; size of the group of each)."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys])
    group = np.cumsum(new) - 1
    return order, new, np.bincount(group, minlength=1)[group] if len(order) else group


def _split(of: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The distinct values of a sorted column, and the other columns cut where it changes."""
    edge = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else np.zeros(0, np.int64)
    return of[edge], [np.split(c, edge[1:]) if len(of) else [] for c in columns]


def _entries(h: np.ndarray, k1: np.ndarray, k2: np.ndarray, at: np.ndarray):
    """Each hash once with its first place; then one row per text with its places whose hash repeats here.

    So an anchor that stands everywhere leaves a worker once a flush, however many
    places it has; ``many`` says that its places here are known already.
    """
    order, new, size = _grouped(h)
    one = order[new]
    yield pd.DataFrame({"h": h[one], "k1": k1[one], "k2": k2[one], "at": at[one], "many": size[new] > 1, "places": None})
    known = np.sort(order[size > 1])  # by text and place again
    if len(known):
        edge = np.flatnonzero(np.concatenate([[True], (k1[known][1:] != k1[known][:-1]) | (k2[known][1:] != k2[known][:-1])]))
        yield pd.DataFrame({"h": None, "k1": k1[known[edge]], "k2": k2[known[edge]], "at": None, "many": True, "places": np.split(at[known], edge[1:])})


def _by_text(groups: int, k1: np.ndarray, k2: np.ndarray, at: np.ndarray) -> pd.DataFrame:
    """Places as one row per group of texts, so that rows do not multiply with the texts."""
    group = ((k1.view(U) >> U(16)) % U(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    values, (a, b, c) = _split(group[order], k1[order], k2[order], at[order])
    return pd.DataFrame({"bucket": values, "d1": None, "d2": None, "k1": [x.tobytes() for x in a], "k2": [x.tobytes() for x in b], "at": [x.tobytes() for x in c], "many": None})


def _windows_packed(groups: int, d1: np.ndarray, d2: np.ndarray, k1: np.ndarray, k2: np.ndarray, at: np.ndarray):
    """Each digest once with its first place, as one row per bucket of digests; then the places whose digest repeats here, by text."""
    order, new, size = _grouped(d2, d1.view(U))
    one = order[new]
    bucket = ((d1[one].view(U) >> U(16)) // U(-(-(1 << 48) // groups))).astype(np.int64)
    values, parts = _split(bucket, d1[one], d2[one], k1[one], k2[one], at[one], size[new] > 1)
    yield pd.DataFrame({"bucket": values, **{n: [x.tobytes() for x in p] for n, p in zip(("d1", "d2", "k1", "k2", "at", "many"), parts, strict=True)}})
    known = order[size > 1]
    if len(known):
        yield _by_text(groups, k1[known], k2[known], at[known])


def _anchor_rows(window: int):
    def run(frames):
        for held in _flushes(frames):
            found = []
            for part in held:
                words = words_of(texts_of(part["text"]))
                _, pos, core = anchors(words.hash, words.first, window)
                pos = np.unique(pos)
                owner = np.searchsorted(words.first, pos, "right") - 1
                found.append((core[pos].view(np.int64), part["k1"].to_numpy(np.int64)[owner], part["k2"].to_numpy(np.int64)[owner], (pos - words.first[owner]).astype(np.int32)))
            h, *place = (np.concatenate(x) for x in zip(*found, strict=True))
            yield from _entries(h, *place)

    return run


class FingerprintIndex:
    """Sorted immutable runs under a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, window: int, buckets: int, fan_in: int, names: list[str], number: int):
        self.spark, self.path, self.window, self.buckets, self.fan_in, self.number = spark, path, window, buckets, fan_in, number
        self.merged: list[tuple[str, str]] = []
        self.stages = Stages(spark, "index-work")
        self.runs = [self._open_run(n) for n in names]

    @classmethod
    def create(cls, spark: SparkSession, path: str, window: int = 35, buckets: int | None = None, fan_in: int = 3) -> FingerprintIndex:
        """An empty index; it has as many buckets as the session has shuffle partitions, unless given, so that a shuffled batch meets them as they are."""
        index = cls(spark, path, window, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), fan_in, [], 0)
        index._publish()
        return index

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> FingerprintIndex:
        """The index under path as its last complete manifest describes it."""
        return cls(spark, path, **json.loads(read_latest(spark, path, "manifest-")))

    def _publish(self) -> None:
        """Name the live runs in a new manifest; it counts once it is complete."""
        self.number += 1
        state = {"window": self.window, "buckets": self.buckets, "fan_in": self.fan_in, "names": [n for n, _ in self.runs], "number": self.number}
        make_text_file(self.spark, f"{self.path}/manifest-{self.number:08d}", json.dumps(state))

    def _open_run(self, name: str) -> tuple[str, str]:
        table = "tessera_" + uuid.uuid4().hex
        place = "struct<k1: bigint, k2: bigint, at: int>"
        self.spark.sql(f"CREATE TABLE {table} (h BIGINT, k1 BIGINT, k2 BIGINT, at INT, many BOOLEAN, woken ARRAY<{place}>) USING parquet CLUSTERED BY (h) SORTED BY (h) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{name}'")
        return name, table

    def _write_run(self, rows: DataFrame) -> tuple[str, str]:
        """A new run, in buckets sorted by hash; woken are places in older runs that were alone until now."""
        name, table = f"run-{uuid.uuid4().hex}", "tessera_" + uuid.uuid4().hex
        rows.select("h", "k1", "k2", "at", "many", "woken").write.format("parquet").bucketBy(self.buckets, "h").sortBy("h").option("path", f"{self.path}/{name}").option("compression", "zstd").saveAsTable(table)
        return name, table

    def add(self, batch: DataFrame) -> DataFrame:
        """Take in batch(k1, k2, text), texts that differ and are not in the index yet; return its hits.

        Hits are the places (k1, k2, places) of anchors that stand at two places or
        more: those of the batch, and those in the runs that it repeats.  They are
        read when they are used, before the index is closed.
        """
        found = self.stages.keep(batch.select("k1", "k2", "text").mapInPandas(_anchor_rows(self.window), _ENTRY), "entries")
        entries = found.filter("h is not null").select("h", "k1", "k2", "at", "many")
        new = entries.groupBy("h").agg(F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("at").alias("at"), (F.bool_or("many") | (F.count("*") > 1)).alias("many"))
        woken = []
        for i, (_, table) in enumerate(self.runs):
            old = self.spark.table(table).select("h", F.col("many").alias(f"many{i}"), F.struct("k1", "k2", "at").alias(f"place{i}"))
            new = new.join(old.hint("merge"), "h", "left").withColumn("many", F.col("many") | F.col(f"many{i}").isNotNull())
            woken.append(F.when(~F.col(f"many{i}"), F.col(f"place{i}")))
        none = F.array().cast("array<struct<k1: bigint, k2: bigint, at: int>>")
        run = self._write_run(new.withColumn("woken", F.filter(F.array(*woken), lambda p: p.isNotNull()) if woken else none))
        self.runs.append(run)
        self._publish()
        rows = self.spark.table(run[1])
        own = entries.filter("not many").join(rows.filter("many").select("h"), "h", "left_semi")
        alone = own.select("k1", "k2", "at").unionByName(rows.filter("size(woken) > 0").select(F.inline("woken")).select("k1", "k2", "at"))
        if len(self.runs) >= self.fan_in:
            self.compact()
        return alone.select("k1", "k2", F.array("at").alias("places")).unionByName(found.filter("h is null").select("k1", "k2", "places"))

    def compact(self) -> None:
        """Merge all runs into one; the old ones go on close(), as hits may still be read from them.

        The runs are read as plain files: over a union of bucketed tables Spark
        would take the buckets for merged already and aggregate each table by itself.
        """
        rows = self.spark.read.schema("h long, k1 long, k2 long, at int, many boolean").parquet(*[f"{self.path}/{name}" for name, _ in self.runs])
        merged = rows.groupBy("h").agg(F.first("k1").alias("k1"), F.first("k2").alias("k2"), F.first("at").alias("at"), (F.bool_or("many") | (F.count("*") > 1)).alias("many"))
        self.merged += self.runs
        self.runs = [self._write_run(merged.withColumn("woken", F.array().cast("array<struct<k1: bigint, k2: bigint, at: int>>")))]
        self._publish()

    def close(self) -> None:
        """Delete the runs that were merged into others and forget the session's names; live runs and the manifest stay."""
        for name, table in self.runs + self.merged:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            if (name, table) in self.merged:
                self.stages.drop(f"{self.path}/{name}")
        self.runs, self.merged = [], []
        self.stages.drop()


def _digests(words, starts: np.ndarray, window: int) -> np.ndarray:
    """128-bit digests (two numbers each) of the windows at these words, over the bytes of their words joined by one space."""
    sizes = words.end - words.start
    solid = words.data[np.repeat(words.start - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]
    at = np.cumsum(sizes + 1) - sizes - 1
    joined = np.full(len(solid) + len(sizes), 32, np.uint8)
    joined[np.arange(len(solid)) + np.repeat(np.arange(len(sizes)), sizes)] = solid
    joined = joined.tobytes()
    last = starts + window - 1
    made = [hashlib.blake2b(joined[a:b], digest_size=16).digest() for a, b in zip(at[starts].tolist(), (at[last] + sizes[last]).tolist(), strict=True)]
    return np.frombuffer(b"".join(made), np.int64).reshape(-1, 2)


def _window_rows(window: int, groups: int):
    """The windows around the hits of each text, by digest."""

    def run(frames):
        for held in _flushes(frames):
            found = []
            for part in held:
                words = words_of(texts_of(part["text"]))
                starts, pos, _ = anchors(words.hash, words.first, window)
                wanted = np.zeros(int(words.first[-1]) + 1, bool)
                for k, hits in enumerate(part["hits"]):
                    wanted[words.first[k] + np.asarray(hits, np.int64)] = True
                starts = starts[wanted[pos]]
                d = _digests(words, starts, window)
                owner = np.searchsorted(words.first, starts, "right") - 1
                found.append((d[:, 0], d[:, 1], part["k1"].to_numpy(np.int64)[owner], part["k2"].to_numpy(np.int64)[owner], (starts - words.first[owner]).astype(np.int32)))
            yield from _windows_packed(groups, *(np.concatenate(x) for x in zip(*found, strict=True)))

    return run


def _gathered(frames):
    """Rows of one partition, sorted by bucket, bucket by bucket."""
    now, rows = None, []
    for frame in frames:
        for row in frame.itertuples(index=False):
            if row.bucket != now and rows:
                yield rows
                rows = []
            now = row.bucket
            rows.append(row)
    if rows:
        yield rows


def _joined(rows: list, **columns) -> list[np.ndarray]:
    return [np.concatenate([np.frombuffer(getattr(r, c), t) for r in rows]) for c, t in columns.items()]


def _repeated(groups: int):
    """Places whose digest stands at two or more, by text, from rows by bucket of digests."""

    def run(frames):
        for rows in _gathered(frames):
            for r in rows:
                if r.d1 is None:
                    yield pd.DataFrame([r._asdict()])
            rows = [r for r in rows if r.d1 is not None]
            if rows:
                d1, d2, k1, k2, at, many = _joined(rows, d1=np.int64, d2=np.int64, k1=np.int64, k2=np.int64, at=np.int32, many=bool)
                order, _, size = _grouped(d2, d1)
                hit = order[(size > 1) & ~many[order]]
                if len(hit):
                    yield _by_text(groups, k1[hit], k2[hit], at[hit])

    return run


def _per_text(frames):
    """All places of each text in one row, from rows by group of texts."""
    for rows in _gathered(frames):
        k1, k2, at = _joined(rows, k1=np.int64, k2=np.int64, at=np.int32)
        order = np.lexsort((at, k2, k1))
        k1, k2, at = k1[order], k2[order], at[order]
        edge = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
        yield pd.DataFrame({"k1": k1[edge], "k2": k2[edge], "places": [p.tobytes() for p in np.split(at, edge[1:])]})


def _strip(window: int, with_text: bool):
    def run(frames):
        for part in chunks(frames):
            out = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            for text, copies, blob in zip(texts_of(part["text"]), part["copies"], part["places"], strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                cover = np.zeros(len(words) + 1, np.int64)
                if len(words) >= window:
                    if copies > 1:
                        starts = np.arange(len(words) - window + 1)
                    else:
                        starts = np.frombuffer(blob or b"", np.int32).astype(np.int64)
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, starts + window, -1)
                gone = np.cumsum(cover)[:-1] > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if gone.any() else b" ".join(words)
                out["n_words"].append(len(words))
                out["n_removed"].append(int(gone.sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                out["kept_text"].append(kept.decode("utf-8", "surrogatepass") if with_text else None)
            yield pd.DataFrame({"key": part["key"], "copies": part["copies"], **out})

    return run


def remove_repeats(docs: DataFrame, window: int = 35, batches: int = 4, fan_in: int = 3, bucket_chars: int = 8 << 20, with_text: bool = False) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts elsewhere.

    Words are the runs outside ASCII white space, unchanged; "elsewhere" is any
    other start, in the same text too; windows are judged on the input.  Rows with
    equal texts become one text first, known by the 128 bits of its md5; if such a text
    has ``window`` words, all its windows repeat and nothing of it is kept.  The
    texts enter the index in ``batches`` by their key, and runs are merged at
    the fan-in.  A passage that stands everywhere costs one entry a flush of a
    worker, never a pair.  Windows around hits are verified by a 128-bit
    cryptographic digest over the bytes of all their words, in buckets of
    about bucket_chars characters of text, one bucket in memory at a time.

    Null counts as empty; texts under ``window`` words lose nothing; rows that
    repeat an id, or have none, are judged by their text.  Returns
    doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space) and, if asked for, kept_text; one row per input row.
    """
    if window < CORE + 1:
        raise ValueError(f"a window has at least {CORE + 1} words")
    spark, stages = docs.sparkSession, Stages(docs.sparkSession, "substring")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    k1, k2 = text_key(F.col("text"))
    texts = base.select(k1.alias("k1"), k2.alias("k2"), "text").groupBy("k1", "k2").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    texts = texts.withColumn("batch", F.pmod("k2", F.lit(batches)).cast("int")).withColumn("chars", F.length("text"))
    texts = stages.keep_bucketed(texts, "texts", buckets, ["k1", "k2"], "batch")
    total, chars = texts.agg(F.sum("copies"), F.sum(F.col("chars").cast("long"))).first()
    groups = max(8, -(-(chars or 0) // bucket_chars))
    index = FingerprintIndex.create(spark, f"{stages.path}/index", window, None, fan_in)
    hits = reduce(DataFrame.unionByName, [index.add(texts.filter(F.col("batch") == k)) for k in range(batches)])
    by_text = hits.groupBy("k1", "k2").agg(F.flatten(F.collect_list("places")).alias("hits"))  # no more than the words of a text
    rows = texts.select("k1", "k2", "text").join(by_text, ["k1", "k2"]).mapInPandas(_window_rows(window, groups), _PACKED)
    repeated = rows.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_repeated(groups), _PACKED).select("bucket", "k1", "k2", "at")
    starts = stages.keep(repeated.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_per_text, "k1 long, k2 long, places binary"), "starts")
    index.close()
    judged = texts.join(starts, ["k1", "k2"], "left").select(F.md5("text").alias("key"), "copies", "text", "places")
    made = stages.keep(judged.mapInPandas(_strip(window, with_text), "key string, copies long, n_words long, n_removed long, kept_sha256 string, kept_text string"), "made")
    light = base.select("doc_id", F.md5("text").alias("key"))
    if with_text:
        return light.join(made, "key", "left").select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")
    out = join_groups(light, made.drop("kept_text"), "key", "copies", int(total or 0))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")
