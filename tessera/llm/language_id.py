"""Language identification with bit-sliced Bloom filters over character n-grams."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Stages
from .textkit import U, chunks, mix, texts_of

WIDTHS = (2, 3, 4)
UNDETERMINED = "und"
_LETTERS: list[np.ndarray] = []


def held_out(id_col: Column) -> Column:
    """Rows that no model learns from: crc32 of the id as text, modulo 4, is 2.  A null id counts as ""."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def grams(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the letter n-grams of lower-cased texts, their owners, and which texts have a letter.

    Runs of other characters become one space; an n-gram may begin or end with
    that space, so word edges count, but holds none inside.
    """
    raw = [(" " + t.lower() + " ") if t else " " for t in texts]
    codes = np.frombuffer("".join(raw).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(raw), dtype=np.int32), [len(r) for r in raw])
    letter = _letters()[codes]
    has = np.zeros(len(raw), bool)
    has[owner[letter]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[:1] = True
    x, letter, owner = np.where(letter, codes, 32)[keep].astype(U), letter[keep], owner[keep]
    all_hashes, owners = [], []
    for n in WIDTHS:
        m = len(x) - n + 1
        if m <= 0:
            continue
        ok = letter[1 : 1 + m].copy() if n > 2 else letter[:m] | letter[1 : 1 + m]
        for k in range(2, n - 1):
            ok &= letter[k : k + m]
        at = np.flatnonzero(ok)
        h = x[at]
        for k in range(1, n):
            h = h * U(0x110001) + x[at + k]
        all_hashes.append(mix(h + U(n * 0x1E3779B97F4A7C15)))
        owners.append(owner[at + 1])
    return np.concatenate(all_hashes) if all_hashes else np.zeros(0, U), np.concatenate(owners) if owners else np.zeros(0, np.int32), has


@dataclass
class LanguageFilter:
    """Slots hold one bit per language, in as many words of 64 as they need: one probe answers for all languages at once.

    Masks and slots are flat where one word is enough, else they have a row of words each.
    """

    languages: list[str]
    slots: np.ndarray
    hashes: int
    false_positive: np.ndarray

    @classmethod
    def build(cls, languages: list[str], gram: np.ndarray, mask: np.ndarray, slots: int, hashes: int) -> LanguageFilter:
        if len(languages) > 64 * (mask.shape[1] if mask.ndim == 2 else 1):
            raise ValueError("masks have too few words for the languages")
        table = np.zeros((slots, *mask.shape[1:]), U)
        for k in range(hashes):
            np.bitwise_or.at(table, cls.probe(gram, k, slots), mask)
        fill = np.array([cls.bit(table, b).mean() for b in range(len(languages))])
        return cls(languages, table, hashes, fill**hashes)

    @staticmethod
    def bit(masks: np.ndarray, b: int) -> np.ndarray:
        """Which masks hold language b."""
        return ((masks[:, b // 64] if masks.ndim == 2 else masks) >> U(b % 64)) & U(1) == 1

    @staticmethod
    def probe(gram: np.ndarray, k: int, slots: int) -> np.ndarray:
        """The k-th slot of each n-gram: the low half of its hash, stepped by the high half."""
        low = gram & U(0xFFFFFFFF)
        return ((low + U(k) * (gram >> U(32) | U(1)) if k else low) % U(slots)).astype(np.int64)

    @staticmethod
    def slots_for(grams: int, hashes: int, false_positive: float) -> int:
        """The power of two from which a language with so many n-grams answers wrongly at most that often."""
        need = -grams * hashes / math.log(1 - false_positive ** (1 / hashes))
        return 1 << max(16, math.ceil(math.log2(max(need, 1))))

    def lookup(self, gram: np.ndarray) -> np.ndarray:
        """The languages containing each n-gram, as bit masks."""
        out = self.slots[self.probe(gram, 0, len(self.slots))]
        for k in range(1, self.hashes):
            out &= self.slots[self.probe(gram, k, len(self.slots))]
        return out

    def evidence(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Corrected n-gram counts per text and language, n-grams per text, and whether a text has letters."""
        gram, owner, has = grams(texts)
        mask = self.lookup(gram)
        total = np.bincount(owner, minlength=len(texts)).astype(float)
        hits = np.stack([np.bincount(owner[self.bit(mask, b)], minlength=len(texts)) for b in range(len(self.languages))], axis=1)
        fp = self.false_positive[None, :]
        return np.maximum(hits - total[:, None] * fp, 0) / np.maximum(1 - fp, 1e-9), total, has

    def predict(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (share of the corrected evidence) and covered share of the n-grams."""
        found, total, has = self.evidence(texts)
        best = found.argmax(axis=1)
        top, whole = found.max(axis=1), found.sum(axis=1)
        score = np.where(has, np.divide(top, whole, out=np.zeros_like(top), where=whole > 0), 0.0)
        names = [self.languages[b] if h else UNDETERMINED for b, h in zip(best, has, strict=True)]
        return names, score, np.where(has, np.divide(top, total, out=np.zeros_like(top), where=total > 0), 0.0)


def _sure(counts: list[int], numbers: list[int], least: int) -> int:
    """The count that at least ``least`` n-grams reach, 1 if fewer are there."""
    order = np.argsort(counts)[::-1]
    enough = np.flatnonzero(np.cumsum(np.array(numbers)[order]) >= least)
    return int(np.array(counts)[order][enough[0]]) if len(enough) else 1


def train(docs: DataFrame, per_language: int = 1000, longest: int = 1_000_000, hashes: int = 2, false_positive: float = 0.03, least_share: float = 0.35, least_count: int = 4, least_grams: int = 5000) -> LanguageFilter | None:
    """Fit the filters on rows that are not held out and have a language; every language is learnt.

    At most per_language rows of each language, of at most ``longest``
    characters, are used, chosen by a hash of the row; their whole texts are
    counted in the cluster.  An n-gram enters the filter of every language whose
    relative frequency is at least least_share of the highest one, if it was
    seen least_count times or more; rarer ones too until a language has
    least_grams, so that one with few or short rows is known as well.  The
    filters are sized by the n-grams of the largest language.  None if no row can
    be learnt from.
    """
    spark, stages = docs.sparkSession, Stages(docs.sparkSession, "language")
    eligible = docs.filter((F.length("text") <= longest) & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text", F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 31) - 1)).alias("u"))
    sizes = [(r["lang"], r["n"]) for r in eligible.groupBy("lang").agg(F.count("*").alias("n")).collect()]
    if not sizes:
        return None
    # a cut that about twice the wanted rows pass, so that few rows and not whole languages are ranked
    below = spark.createDataFrame([(name, int((1 << 31) * min(1.0, 2 * per_language / n))) for name, n in sizes], "lang string, below long")
    ranked = eligible.join(F.broadcast(below), "lang").filter("u < below").withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("u")))
    sample = ranked.filter(F.col("r") <= per_language).select("lang", "text")

    def count(frames):
        for part in chunks(frames):
            gram, owner, _ = grams(texts_of(part["text"]))
            langs, code = np.unique(part["lang"].to_numpy(str), return_inverse=True)
            for k, name in enumerate(langs):
                g, n = np.unique(gram[code[owner] == k], return_counts=True)
                yield pd.DataFrame({"lang": str(name), "gram": g.view(np.int64), "n": n})

    n_parts = spark.sparkContext.defaultParallelism
    counts = stages.keep(sample.repartition(n_parts).mapInPandas(count, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n")), "counts")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("sum"))
    rated = counts.join(F.broadcast(sums), "lang").select("gram", F.struct("lang", "n", (F.col("n") / F.col("sum")).alias("rate")).alias("x"))
    by_gram = rated.groupBy("gram").agg(F.sum("x.n").alias("total"), F.max("x.rate").alias("top"), F.collect_list("x").alias("by"))
    own = stages.keep(by_gram.select("gram", "total", "top", F.inline("by")).filter(F.col("rate") >= least_share * F.col("top")).select("gram", "lang", "n", "total"), "own")
    numbers: dict[str, list[tuple[int, int]]] = {}
    for r in own.groupBy("lang", "n").agg(F.count("*").alias("k")).collect():
        numbers.setdefault(r["lang"], []).append((r["n"], r["k"]))
    languages = sorted(numbers)
    if not languages:
        return None
    cuts = [(name, i, _sure(*map(list, zip(*numbers[name], strict=True)), least_grams)) for i, name in enumerate(languages)]
    kept = own.join(F.broadcast(spark.createDataFrame(cuts, "lang string, code int, sure long")), "lang").filter((F.col("total") >= least_count) | (F.col("n") >= F.col("sure")))
    rows = kept.select("gram", "code").toPandas()
    stages.drop()
    gram, at = np.unique(rows["gram"].to_numpy(np.int64), return_inverse=True)
    code = rows["code"].to_numpy(np.int64)
    mask = np.zeros((len(gram), -(-len(languages) // 64)), U)
    np.bitwise_or.at(mask, (at, code // 64), U(1) << (code % 64).astype(U))
    slots = LanguageFilter.slots_for(int(np.bincount(code).max()), hashes, false_positive)
    return LanguageFilter.build(languages, gram.view(U), mask if len(languages) > 64 else mask[:, 0], slots, hashes)


def identify(docs: DataFrame, model: LanguageFilter | None, text_col: str = "text") -> DataFrame:
    """docs(doc_id, text) with lang_pred, score and coverage, in place of its text.

    Null texts, texts without a letter, and all texts where there is no model
    (nothing to learn from) are "und" with score 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames):
        for part in chunks(frames):
            texts = texts_of(part["text"])
            own = shared.value
            names, score, covered = own.predict(texts) if own else ([UNDETERMINED] * len(texts), 0.0, 0.0)
            yield pd.DataFrame({"doc_id": part["doc_id"], "lang_pred": names, "score": score, "coverage": covered})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, lang_pred string, score double, coverage double")


def keep_identified(docs: DataFrame, model: LanguageFilter | None, least_coverage: float = 0.05) -> DataFrame:
    """The rows of docs whose language can be told: a letter, and some n-gram known for it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def known(column: pd.Series) -> pd.Series:
        out = np.zeros(len(column), bool)
        at = 0
        for part in chunks([pd.DataFrame({"text": column})]):
            own = shared.value
            if own:
                names, _, covered = own.predict(texts_of(part["text"]))
                out[at : at + len(part)] = (np.array(names) != UNDETERMINED) & (covered >= least_coverage)
            at += len(part)
        return pd.Series(out)

    return docs.filter(known("text"))
