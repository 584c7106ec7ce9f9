"""Which barcodes are cells: thresholds by rank, by number, within an order of magnitude, and against ambient RNA."""

from __future__ import annotations

import math
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut
from .order import numbered


def marked(summary: DataFrame, threshold: DataFrame) -> DataFrame:
    """The summary with mark CB (molecules at or above the one-row threshold) or UB."""
    return summary.crossJoin(F.broadcast(threshold)).withColumn("mark", F.when(F.col("umi") >= F.col("threshold"), "CB").otherwise("UB"))


def auto_threshold(summary: DataFrame, expected: int) -> DataFrame:
    """A tenth of the molecules at rank expected/100 (at most the number of barcodes), at least 1.

    Works on the histogram of molecules, so no global sort of barcodes is needed.
    """
    histogram = summary.groupBy("umi").agg(F.count("*").alias("n"))
    ranked = histogram.select("umi", F.sum("n").over(Window.orderBy(F.desc("umi"))).alias("upto"), F.sum("n").over(Window.partitionBy(F.lit(1))).alias("total"))
    rank = F.least(F.lit(int(expected * 0.01)), F.col("total"))
    at = ranked.filter((F.col("upto") >= rank) & (rank > 0)).agg(F.max("umi").alias("u"))
    return at.select(F.greatest(F.lit(1), F.floor(F.col("u") * 0.1)).cast("long").alias("threshold"))


def forced_threshold(summary: DataFrame, cells: int) -> DataFrame:
    """The molecule count whose cumulative number of barcodes is nearest to the wanted one; the higher count on ties."""
    histogram = summary.groupBy("umi").agg(F.count("*").alias("n"))
    w = Window.orderBy(F.desc("umi"))
    cum = histogram.select("umi", F.sum("n").over(w).alias("upto"))
    return cum.agg(F.min_by("umi", F.struct(F.abs(F.col("upto") - cells), -F.col("umi"))).alias("threshold"))


def within_magnitude(summary: DataFrame, recovered: int) -> DataFrame:
    """One-row threshold: a tenth (half to even) of the molecules at the 99th percentile rank of the recovered cells."""
    k = max(1, round(recovered * 0.01))
    histogram = summary.filter("umi > 0").groupBy("umi").agg(F.count("*").alias("n"))
    cum = histogram.select("umi", F.sum("n").over(Window.orderBy(F.desc("umi"))).alias("upto"), F.sum("n").over(Window.partitionBy(F.lit(1))).alias("total"))
    at = cum.filter(F.col("upto") >= F.greatest(F.lit(1), F.least(F.lit(k), F.col("total") - 1))).agg(F.max("umi").alias("u"))
    return at.select(F.greatest(F.lit(1), F.bround(F.col("u") * F.lit(0.1), 0)).cast("long").alias("threshold"))


def bootstrap_magnitude(summary: DataFrame, recovered: int, rounds: int = 100, seed: int = 0) -> int:
    """Mean number, over resamples of the barcodes, of barcodes within a tenth of the baseline.

    Resamples are drawn from the histogram (one row per distinct count), which is
    all that leaves the cluster.
    """
    h = summary.filter("umi > 0").groupBy("umi").agg(F.count("*").alias("n")).orderBy("umi").toPandas()
    if not len(h):
        return 0
    values, n = h["umi"].to_numpy(), h["n"].to_numpy()
    total = int(n.sum())
    k = max(1, min(round(recovered * 0.01), total - 1))
    rng, tops = np.random.default_rng(seed), []
    for _ in range(rounds):
        drawn = rng.multinomial(total, n / total)
        above = np.cumsum(drawn[::-1])[::-1]
        baseline = values[np.flatnonzero(above >= k)[-1]]
        tops.append(int(drawn[values >= max(1, round(0.1 * baseline))].sum()))
    return round(float(np.mean(tops)))


def top_barcodes(summary: DataFrame, n: int) -> DataFrame:
    """The n barcodes with most molecules, ties by barcode."""
    return summary.filter("umi > 0").orderBy(F.desc("umi"), "barcode").limit(n)


def cell_metrics(molecules: DataFrame, marks: DataFrame) -> DataFrame:
    """One row: cells, reads in cells and their share, medians and means over cells, genes found in cells."""
    per = marks.filter("mark = 'CB'")
    genes = molecules.join(per.select("barcode"), "barcode", "left_semi").agg(F.count_distinct("gene").alias("total_genes"))
    cells = per.agg(
        F.count("*").alias("cells"), F.sum("readcount").alias("reads_in_cells"), F.median("umi").cast("int").alias("median_umi"), F.median("genes").cast("int").alias("median_genes"),
        F.avg("umi").cast("int").alias("mean_umi"), F.sum("umi").alias("umi_in_cells"),
    )
    every = marks.agg(F.sum("readcount").alias("reads"))
    return cells.crossJoin(genes).crossJoin(every).select("*", F.bround(F.col("reads_in_cells") / F.col("reads") * 100, 2).alias("pct_reads_in_cells"), F.floor(F.col("reads") / F.col("cells")).cast("long").alias("mean_reads"))


def adjust_bh(tests: DataFrame, p: str = "p", by: list[str] | None = None) -> DataFrame:
    """Benjamini-Hochberg q of each row: the least of p * n / rank over the rows at or above it."""
    by = by or []
    part = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    ranked = tests.withColumn("_n", F.count("*").over(part)).withColumn("_r", F.rank().over(part.orderBy(p)) + F.count("*").over(Window.partitionBy(*by, p)) - 1)
    down = part.orderBy(F.desc(p)).rangeBetween(Window.unboundedPreceding, 0)
    return ranked.withColumn("q", F.least(F.lit(1.0), F.min(F.col(p) * F.col("_n") / F.col("_r")).over(down))).drop("_n", "_r")


def good_turing(r: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """Simple Good-Turing: adjusted frequencies of the ascending distinct frequencies r seen n times, and the unseen mass.

    Takes the Turing estimate while it differs significantly from the log-linear
    one, the latter from the first place where it does not.
    """
    r, n = np.asarray(r, float), np.asarray(n, float)
    total = float((r * n).sum())
    step = np.diff(r, prepend=r[0] - 1)
    width = np.append((step[1:] + step[:-1]) / 2, step[-1])
    x, y = np.log(r), np.log(n / width)
    slope = float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum())
    if slope > -1:
        raise ValueError(f"the log-log slope {slope:.3f} is above -1: the estimate does not apply")
    linear = (1 + 1 / r) ** (1 + slope)
    following = np.append(r[1:] == r[:-1] + 1, False)
    up = np.append(n[1:], 0.0)
    turing = np.where(following, (r + 1) / r * up / n, 0.0)
    place = np.arange(len(r))
    spread = np.where(following, (place + 2) / n * np.sqrt(up * (1 + up / n)), 1.0)
    differs = np.abs(linear - turing) * (place + 1) / spread > 1.65
    chosen = np.where(np.logical_and.accumulate(differs), turing, linear)
    unseen = n[0] / total
    return r * chosen * (1 - unseen) / float((chosen * r * n).sum() / total), unseen


def ambient_profile(gene_totals: pd.DataFrame) -> pd.DataFrame:
    """Smoothed share of each gene from gene_totals(gene, total); genes at 0 share the unseen mass."""
    seen = gene_totals[gene_totals["total"] > 0]
    r, n = np.unique(seen["total"].to_numpy(), return_counts=True)
    if len(r) < 10:
        raise ValueError(f"only {len(r)} distinct frequencies")
    star, p0 = good_turing(r, n)
    share = dict(zip(r.tolist(), ((1 - p0) * star / (n * star).sum()).tolist(), strict=True))
    zero = len(gene_totals) - len(seen)
    out = gene_totals.assign(p=[share[t] if t > 0 else p0 / zero for t in gene_totals["total"].tolist()])
    return out if zero else out.assign(p=out["p"] / out["p"].sum())


def log_likelihoods(molecules: DataFrame, profile: pd.DataFrame) -> DataFrame:
    """(barcode, umi, loglik) of drawing each barcode's genes from the profile."""
    spark = molecules.sparkSession
    p = spark.createDataFrame(profile[["gene", "p"]])

    @F.pandas_udf("double")
    def log_factorial(column: pd.Series) -> pd.Series:
        values, at = np.unique(column.to_numpy(np.int64), return_inverse=True)  # few counts are distinct
        return pd.Series(np.array([math.lgamma(v + 1) for v in values.tolist()])[at])

    counts = molecules.groupBy("barcode", "gene").agg(F.count("*").alias("x")).join(p, "gene")
    sums = counts.select("barcode", "x", (F.col("x") * F.log("p") - log_factorial(F.col("x"))).alias("t")).groupBy("barcode").agg(F.sum("x").alias("umi"), F.sum("t").alias("t"))
    return sums.select("barcode", "umi", (log_factorial(F.col("umi")) + F.col("t")).alias("loglik"))


def simulated_counts(spark, observed: pd.DataFrame, profile: np.ndarray, sims: int = 10_000, seed: int = 0, blocks: int = 16) -> pd.DataFrame:
    """How many simulated draws lie below each observed (umi, loglik): blocks of simulations run as separate tasks.

    A simulation grows one sample through the distinct totals in ascending order.
    """
    sizes = np.sort(observed["umi"].unique())
    of = {n: np.flatnonzero(observed["umi"].to_numpy() == n) for n in sizes.tolist()}
    seen, logp = observed["loglik"].to_numpy(), np.log(profile)
    lg = np.array([math.lgamma(k + 1) for k in range(int(sizes[-1]) + 1)])

    def run(frames):
        for frame in frames:
            below = np.zeros(len(seen), np.int64)
            for block in frame["block"]:
                rng = np.random.default_rng([seed, int(block)])
                for _ in range(sims // blocks + (block < sims % blocks)):
                    counts, done = np.zeros(len(profile), np.int64), 0
                    for n in sizes.tolist():
                        counts += rng.multinomial(n - done, profile)
                        done = n
                        value = lg[n] - lg[counts].sum() + float(counts @ logp)
                        below[of[n]] += value < seen[of[n]]
            yield pd.DataFrame({"i": np.arange(len(seen)), "below": below})

    return spark.range(0, blocks, 1, blocks).withColumnRenamed("id", "block").mapInPandas(run, "i long, below long").groupBy("i").agg(F.sum("below").alias("below")).orderBy("i").toPandas()


def empty_drops(molecules: DataFrame, recovered: int = 3000, ambient: tuple[int, int] = (45_000, 90_000), least: int = 500, share: float = 0.01, candidates: int = 20_000, sims: int = 10_000, fdr: float = 0.01) -> DataFrame:
    """Cells by magnitude plus barcodes whose genes do not look ambient: (barcode, umi, cell, loglik, p, q).

    Ambient RNA is estimated from the barcodes of the given ranks.  If there are
    none, or the estimate does not apply, the cells by magnitude stand alone.
    """
    spark = molecules.sparkSession
    summary = cut(molecules.groupBy("barcode").agg(F.count("*").alias("umi")))
    n_cells = bootstrap_magnitude(summary, recovered)
    ranked = numbered(summary.withColumn("_down", -F.col("umi")), "rank", "_down", "barcode").drop("_down")
    cells = ranked.filter(F.col("rank") <= n_cells)
    empty = ranked.filter((F.col("rank") > ambient[0]) & (F.col("rank") <= ambient[1]))
    base = cells.select("barcode", "umi", F.lit("magnitude").alias("cell"), F.lit(None).cast("double").alias("loglik"), F.lit(None).cast("double").alias("p"), F.lit(None).cast("double").alias("q"))
    inside = molecules.join(empty, "barcode", "left_semi").groupBy("gene").agg(F.count("*").alias("t"))
    totals = molecules.select("gene").distinct().join(inside, "gene", "left").select("gene", F.coalesce("t", F.lit(0)).alias("total")).orderBy("gene").toPandas()
    try:
        profile = ambient_profile(totals)
    except ValueError:
        return base
    middle = cells.agg(F.median("umi")).first()[0] or 0
    floor = max(least, math.ceil(middle * share))
    tested = ranked.filter((F.col("rank") > n_cells) & (F.col("umi") >= floor)).orderBy(F.desc("umi"), "barcode").limit(candidates)
    observed = log_likelihoods(molecules.join(tested, "barcode", "left_semi"), profile).orderBy("barcode").toPandas()
    if not len(observed):
        return base
    below = simulated_counts(spark, observed, profile["p"].to_numpy() / profile["p"].sum(), sims)
    observed["p"] = (1 + below["below"].to_numpy()) / (1 + sims)
    q = adjust_bh(spark.createDataFrame(observed)).filter(F.col("q") <= fdr)
    return base.unionByName(q.select("barcode", "umi", F.lit("ambient").alias("cell"), "loglik", "p", "q"))


def rank_curve(summary: DataFrame) -> DataFrame:
    """Change points of the descending molecule curve: first and last rank of each count."""
    histogram = summary.groupBy("umi").agg(F.count("*").alias("n"))
    last = F.sum("n").over(Window.orderBy(F.desc("umi")))
    return histogram.select("umi", (last - F.col("n") + 1).alias("first_rank"), last.alias("last_rank"))


def knee(summary: DataFrame, floor: int = 10, few: int = 100) -> DataFrame:
    """One row: the rank with the least second difference of log10(count + 1) in the first half of the ranks, at least ``floor``.

    With at most ``few`` barcodes it is a tenth of their number.
    """
    w = Window.orderBy("rank")
    base = summary.select("umi", F.row_number().over(Window.orderBy(F.desc("umi"), "barcode")).alias("rank"), F.count("*").over(Window.partitionBy(F.lit(1))).alias("n"))
    y = base.withColumn("y", F.log10(F.col("umi") + 1.0))

    def gradient(c):
        before, after = F.lag(c).over(w), F.lead(c).over(w)
        return F.when(before.isNull(), after - F.col(c)).when(after.isNull(), F.col(c) - before).otherwise((after - before) / 2)

    second = y.withColumn("g", gradient("y")).withColumn("h", F.round(gradient("g"), 9))
    return second.filter(f"rank <= n div 2 or n <= {few}").agg(F.min_by("rank", F.struct("h", "rank")).alias("k"), F.max("n").alias("n")).select(F.when(F.col("n") <= few, F.floor(F.col("n") * 0.1)).otherwise(F.greatest(F.col("k") - 1, F.lit(floor))).cast("int").alias("knee"))


def segments(counts: np.ndarray, start: int, end: int, step: float = 0.02, span: int = 20) -> list[int]:
    """Cuts of the descending curve between two ranks, with both ends; none if the range is empty.

    The arc is measured on log axes that each run from 0 to 1 over the whole
    curve.  A piece ends after the rank at which it is ``step`` long, if that lies
    over ``span`` ranks behind the last cut.  Ranks count from 0; the first of the range
    is 1 or more, and counts in it are positive.
    """
    if end <= start:
        return []
    if start < 1:
        raise ValueError("rank 0 has no place on a log axis")
    i = np.arange(start, end)
    before = np.maximum(start, i - 1)
    y = np.log(np.asarray(counts[:end], float))
    arc = np.hypot((np.log(i) - np.log(before)) / np.log(len(counts)), (y[i] - y[before]) / np.log(float(np.max(counts))))
    cuts, base = [start], 0.0
    along = np.cumsum(arc)
    at = 0
    while True:
        # the first rank where the piece is long enough and spans enough ranks
        k = max(at, int(np.searchsorted(along, base + step)), cuts[-1] + span + 1 - start)
        while k < len(i) and along[k] - base < step:
            k += 1
        if k >= len(i):
            break
        cuts.append(int(i[k]) + 1)
        at, base = k + 1, along[k]
    return cuts if cuts[-1] == end else [*cuts, end]


def curve_segments(summary: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """(first, last) rank of each piece of the curve between two ranks, end exclusive; only the histogram of counts leaves the cluster."""
    rows = summary.filter("umi > 0").groupBy("umi").agg(F.count("*").alias("n")).orderBy(F.desc("umi")).toPandas()
    counts = np.repeat(rows["umi"].to_numpy(), rows["n"].to_numpy())
    cuts = segments(counts, start, min(len(counts), len(counts) if end is None else end))
    return summary.sparkSession.createDataFrame([(int(a), int(b)) for a, b in pairwise(cuts)], "first long, last long")


def call_cells(molecules: DataFrame, method: str = "auto", forced: int | None = None, expected: int = 3000, **options) -> DataFrame:
    """The summary with mark CB or UB and the threshold, by the wanted number of cells if one is given, else by the method.

    Methods: auto (rank), EmptyDrops_CR (magnitude and ambient profile; its
    threshold is the least count of a cell).  Any other name is an error.
    """
    summary = molecules.groupBy("barcode").agg(
        F.sum("cnt").alias("readcount"), F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt"))), F.lit(0)).alias("umi2"), F.count("*").alias("umi"), F.count_distinct("gene").alias("genes")
    )
    if forced is not None:
        return marked(summary, forced_threshold(summary, forced))
    if method == "auto":
        return marked(summary, auto_threshold(summary, expected))
    if method != "EmptyDrops_CR":
        raise ValueError(f"unknown method {method!r}; known are auto and EmptyDrops_CR")
    found = cut(empty_drops(molecules, recovered=expected, **options).select("barcode", F.lit("CB").alias("mark")))
    out = summary.join(found, "barcode", "left").withColumn("mark", F.coalesce("mark", F.lit("UB")))
    least = out.filter("mark = 'CB'").agg(F.min("umi").alias("threshold"))
    return out.crossJoin(F.broadcast(least))
