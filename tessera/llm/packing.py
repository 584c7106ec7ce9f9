"""Packing: length buckets chosen by dynamic programming, token-budget batches inside each."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that minimise the padding over a histogram.

    lengths ascend; each text is padded to its bucket's bound.  cost(i, j) of one
    bucket over lengths i..j-1 satisfies the quadrangle inequality, so each layer
    is solved by divide and conquer in O(n log n), level by level in numpy.
    """
    n = len(lengths)
    if not n:
        return []
    lengths, counts = np.asarray(lengths, np.float64), np.asarray(counts, np.float64)
    rows = np.concatenate([[0.0], np.cumsum(counts)])
    mass = np.concatenate([[0.0], np.cumsum(counts * lengths)])

    def cost(i, j):
        return lengths[j - 1] * (rows[j] - rows[i]) - (mass[j] - mass[i])

    cells = np.arange(1, n + 1)
    best = np.concatenate([[0.0], cost(np.zeros(n, int), cells)])
    choice = []
    for _ in range(1, min(buckets, n)):
        new, cut = best.copy(), np.full(n + 1, -1)
        todo = [(1, n, 0, n - 1)]
        while todo:
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            i = np.arange(a, min(b, j - 1) + 1)
            v = best[i] + cost(i, np.full(len(i), j))
            k = int(v.argmin())
            if v[k] < new[j]:
                new[j] = v[k]
                cut[j] = i[k]
            todo += [(lo, j - 1, a, int(i[k])), (j + 1, hi, int(i[k]), b)]
        choice.append(cut)
        best = new
    bounds, j = [], n
    for cut in reversed(choice):
        if j > 0 and cut[j] >= 0:
            bounds.append(int(lengths[j - 1]))
            j = int(cut[j])
    if j > 0:
        bounds.append(int(lengths[j - 1]))
    return sorted(bounds)


def pack(docs: DataFrame, budget: int = 32_768, buckets: int = 16, tokens: Column | None = None, chunk_rows: int = 16_384) -> DataFrame:
    """Deal every document into a batch of its length bucket.

    tokens is the length of a row (default: words of text).  The exact
    histogram of all lengths, one row per distinct length, reaches the driver,
    which chooses the bucket bounds.  A batch of a bucket holds budget // bound
    rows, at least one.  Batches form independently in chunks of about
    chunk_rows rows dealt by a hash of doc_id, so no task ranks a whole bucket;
    a chunk leaves at most one unfilled batch per bucket.

    Empty texts have length 0 and are padded to their bucket's bound.  Rows
    longer than the budget are kept whole, alone in their batch (oversize).
    Returns doc_id, n_tokens, bucket, padded, batch_id, slot, oversize.
    """
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (word_count(F.col("text")) if tokens is None else tokens.cast("long")).alias("n_tokens"))
    histogram = sized.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").toPandas()
    total = int(histogram["n"].sum())
    bounds = best_boundaries(histogram["n_tokens"].to_numpy(), histogram["n"].to_numpy(), buckets)
    n_chunks = max(1, -(-total // chunk_rows))
    bound = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array().cast("array<long>")
    bucket = F.size(F.filter(bound, lambda b: b < F.col("n_tokens")))
    dealt = sized.withColumn("bucket", bucket).withColumn("padded", F.try_element_at(bound, (F.col("bucket") + 1).cast("int"))).withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)))
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("padded", F.lit(1)))).cast("long")
    rank = F.row_number().over(Window.partitionBy("bucket", "chunk").orderBy("doc_id", "n_tokens")).cast("long") - 1
    ranked = dealt.withColumn("rank", rank).withColumn("room", room)
    return ranked.select(
        "doc_id", "n_tokens", "bucket", "padded", F.concat_ws("-", "bucket", "chunk", F.floor(F.col("rank") / F.col("room")).cast("string")).alias("batch_id"),
        (F.col("rank") % F.col("room")).alias("slot"), (F.col("padded") > budget).alias("oversize"),
    )
