"""Rasters as pixel relations: thresholds, masks, tiles, label stitching and expansion."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut
from .graph import connected
from .order import numbered


def otsu(histogram: DataFrame) -> DataFrame:
    """One row: the level that maximises the variance between the two classes of histogram(level, n); the lowest on ties."""
    w = Window.orderBy("level")
    t = Window.partitionBy(F.lit(1))
    h = histogram.select("level", "n", F.sum("n").over(w).alias("w0"), F.sum(F.col("n") * F.col("level")).over(w).alias("s0"), F.sum("n").over(t).alias("w"), F.sum(F.col("n") * F.col("level")).over(t).alias("s"))
    w1 = F.col("w") - F.col("w0")
    gap = F.try_divide(F.col("s0"), F.col("w0")) - F.try_divide(F.col("s") - F.col("s0"), w1)
    return h.withColumn("v", F.round(F.col("w0") * w1 * gap * gap, 3)).filter("v is not null").agg(F.min_by("level", F.struct(-F.col("v"), "level")).alias("threshold"))


def mean_threshold(histogram: DataFrame) -> DataFrame:
    return histogram.agg((F.sum(F.col("level") * F.col("n")) / F.sum("n")).alias("threshold"))


def max_entropy(histogram: DataFrame) -> DataFrame:
    """One row: the level that maximises the summed entropies of both classes; the lowest on ties."""
    w, t = Window.orderBy("level"), Window.partitionBy(F.lit(1))
    p = histogram.filter("n > 0").select("level", (F.col("n") / F.sum("n").over(t)).alias("p"))
    h = p.select("level", "p", F.sum("p").over(w).alias("c"), F.sum(F.col("p") * F.log("p")).over(w).alias("e"), F.sum(F.col("p") * F.log("p")).over(t).alias("all"))
    rest = 1 - F.col("c")
    total = F.log("c") - F.col("e") / F.col("c") + F.log(rest) - (F.col("all") - F.col("e")) / rest
    return h.filter(rest > 1e-12).withColumn("v", F.round(total, 9)).agg(F.min_by("level", F.struct(-F.col("v"), "level")).alias("threshold"))


def yen(histogram: DataFrame) -> DataFrame:
    """One row: the level with the largest correlation criterion of its two classes (Yen, Chang and Chang 1995); the lowest on ties."""
    w, t = Window.orderBy("level"), Window.partitionBy(F.lit(1))
    p = histogram.filter("n > 0").select("level", (F.col("n") / F.sum("n").over(t)).alias("p"))
    h = p.select("level", F.sum("p").over(w).alias("c"), F.sum(F.col("p") * F.col("p")).over(w).alias("s"), F.sum(F.col("p") * F.col("p")).over(t).alias("all"))
    below, above = F.col("c") * (1 - F.col("c")), F.col("s") * (F.col("all") - F.col("s"))
    return h.filter((1 - F.col("c")) > 1e-12).withColumn("v", F.round(F.log(below * below / above), 9)).agg(F.min_by("level", F.struct(-F.col("v"), "level")).alias("threshold"))


def isodata(histogram: DataFrame) -> DataFrame:
    """One row: the lowest level less than one below the middle of the means of both its classes (Ridler and Calvard 1978), over all levels between the ends."""
    ends = histogram.filter("n > 0").agg(F.min("level").alias("a"), F.max("level").alias("b")).filter("a < b")
    every = ends.select(F.explode(F.sequence("a", "b")).alias("level")).join(histogram, "level", "left").fillna(0, ["n"])
    w, t = Window.orderBy("level"), Window.partitionBy(F.lit(1))
    h = every.select("level", F.sum("n").over(w).alias("k"), F.sum(F.col("n") * F.col("level")).over(w).alias("s"), F.sum("n").over(t).alias("kk"), F.sum(F.col("n") * F.col("level")).over(t).alias("ss"))
    gap = (F.col("s") / F.col("k") + F.try_divide(F.col("ss") - F.col("s"), F.col("kk") - F.col("k"))) / 2 - F.col("level")
    return h.filter((gap >= 0) & (gap < 1)).agg(F.min("level").alias("threshold"))


def _small(histogram: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Levels from the least to the greatest and their counts; a histogram of 8 or 16 bits is small."""
    rows = histogram.filter("n > 0").orderBy("level").limit(1 << 16).toPandas()
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0)
    levels = np.arange(int(rows["level"].min()), int(rows["level"].max()) + 1)
    counts = np.zeros(len(levels))
    counts[rows["level"].to_numpy(np.int64) - levels[0]] = rows["n"].to_numpy(float)
    return levels, counts


def cross_entropy(histogram: DataFrame) -> float | None:
    """The fixed point of minimum cross-entropy (Li and Tam 1998), from the mean on; None without pixels."""
    levels, counts = _small(histogram)
    if not len(levels):
        return None
    x = levels - levels[0]
    now, then = float((x * counts).sum() / counts.sum()), None
    while then is None or abs(now - then) > 0.5:
        then = now
        up = x > then
        if not counts[up].sum() or not counts[~up].sum():
            break
        front, back = (x[up] * counts[up]).sum() / counts[up].sum(), (x[~up] * counts[~up]).sum() / counts[~up].sum()
        if back == 0:
            break
        now = float((back - front) / (np.log(back) - np.log(front)))
    return now + float(levels[0])


def triangle(histogram: DataFrame) -> int | None:
    """The level farthest below the line from the peak to the end of the longer tail (Zack, Rogers and Latt 1977); None without pixels."""
    levels, counts = _small(histogram)
    if not len(levels):
        return None
    peak = int(counts.argmax())
    turned = peak < len(counts) - 1 - peak
    if turned:
        counts, peak = counts[::-1], len(counts) - 1 - peak
    if not peak:
        return int(levels[0])
    # the tail now rises from place 0 to the peak
    x = np.arange(peak)
    norm = np.hypot(counts[peak], peak)
    away = counts[peak] / norm * x - peak / norm * counts[:peak]
    at = int(away.argmax())
    return int(levels[len(counts) - 1 - at if turned else at])


def stretch(values: DataFrame, column: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """A column stretched between two percentiles to 0..255; a flat one becomes 0."""
    q = values.agg(F.percentile(column, F.lit(low)).alias("lo"), F.percentile(column, F.lit(high)).alias("hi"))
    v = F.try_divide(F.col(column) - F.col("lo"), F.col("hi") - F.col("lo"))
    return values.crossJoin(F.broadcast(q)).withColumn("stretched", F.bround(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(v, F.lit(0.0)))) * 255, 0).cast("int")).drop("lo", "hi")


def intersection_over_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: pixels of both and of either of two masks(row, col), and their ratio."""
    both = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), ["row", "col"], "full")
    return both.agg(F.count_if(F.expr("a = 1 and b = 1")).alias("both"), F.count("*").alias("either")).withColumn("iou", F.round(F.try_divide("both", "either"), 9))


def dilate(mask: DataFrame, radius: int, shape: tuple[int, int]) -> DataFrame:
    """The mask grown by a square of the radius, cut to the raster."""
    around = F.sequence(F.lit(-radius), F.lit(radius))
    grown = mask.select("row", "col", F.explode(around).alias("a")).select((F.col("row") + F.col("a")).alias("row"), "col").distinct()
    grown = grown.select("row", "col", F.explode(around).alias("b")).select("row", (F.col("col") + F.col("b")).alias("col")).distinct()
    return grown.filter((F.col("row") >= 0) & (F.col("row") < shape[0]) & (F.col("col") >= 0) & (F.col("col") < shape[1]))


def runs(mask: DataFrame) -> DataFrame:
    """A mask as maximal runs (row, col_start, col_end)."""
    w = Window.partitionBy("row").orderBy("col")
    return mask.withColumn("g", F.col("col") - F.row_number().over(w)).groupBy("row", "g").agg(F.min("col").alias("col_start"), F.max("col").alias("col_end")).drop("g")


def tiles(width: int, height: int, size: int, overlap: int, spark) -> DataFrame:
    """Non-overlapping cores of a raster with windows widened by the overlap and cut to it."""
    ys = spark.range(0, height, size).select(F.col("id").cast("int").alias("core_y0"))
    xs = spark.range(0, width, size).select(F.col("id").cast("int").alias("core_x0"))
    out = ys.crossJoin(F.broadcast(xs)).withColumn("core_y1", F.least(F.lit(height), F.col("core_y0") + size)).withColumn("core_x1", F.least(F.lit(width), F.col("core_x0") + size))
    return out.select("*", F.greatest(F.lit(0), F.col("core_y0") - overlap).alias("y0"), F.greatest(F.lit(0), F.col("core_x0") - overlap).alias("x0"), F.least(F.lit(height), F.col("core_y1") + overlap).alias("y1"), F.least(F.lit(width), F.col("core_x1") + overlap).alias("x1"))


def owned_by_core(centroids: DataFrame, tile: DataFrame) -> DataFrame:
    """Labels whose centroid lies in a tile's half-open core."""
    inside = (F.col("cy") >= F.col("core_y0")) & (F.col("cy") < F.col("core_y1")) & (F.col("cx") >= F.col("core_x0")) & (F.col("cx") < F.col("core_x1"))
    return centroids.join(tile, inside).select("label", "core_y0", "core_x0")


def exclude_labels(labels: DataFrame, boxes: list[tuple[int, int, int, int]]) -> DataFrame:
    """Pixels of labels that touch no box (x0, y0, x1, y1), renumbered densely."""
    touched = F.lit(False)
    for x0, y0, x1, y1 in boxes:
        touched = touched | ((F.col("col") >= x0) & (F.col("col") < x1) & (F.col("row") >= y0) & (F.col("row") < y1))
    kept = numbered(labels.filter("label <> 0").groupBy("label").agg(F.max(touched).alias("t")).filter(~F.col("t")).select("label"), "new_label", "label")
    return labels.join(kept, "label").select("row", "col", F.col("new_label").alias("label"))


def stitch(local: DataFrame, placed: DataFrame, least: float = 0.5) -> DataFrame:
    """Per local label: the placed label it overlaps most (the lower on ties) and whether it merges with it."""
    area = local.filter("label <> 0").groupBy("label").agg(F.count("*").alias("area"))
    over = local.filter("label <> 0").join(placed.filter("label <> 0").withColumnRenamed("label", "other"), ["row", "col"]).groupBy("label", "other").agg(F.count("*").alias("n"))
    best = over.groupBy("label").agg(F.min_by(F.struct("other", "n"), F.struct(-F.col("n"), "other")).alias("b"))
    return area.join(best, "label", "left").select("label", "area", F.col("b.other").alias("other"), F.coalesce("b.n", F.lit(0)).alias("overlap"), (F.coalesce("b.n", F.lit(0)) / F.col("area") >= least).alias("merged"))


def expand(labels: DataFrame, distance: int, shape: tuple[int, int]) -> DataFrame:
    """Background pixels within a distance of labels take the nearest one (the lower label on ties)."""
    seeds = labels.filter("label <> 0")
    steps = [(a, b) for a in range(-distance, distance + 1) for b in range(-distance, distance + 1) if a * a + b * b <= distance * distance]
    near = seeds.select("row", "col", "label", F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(a * a + b * b).alias("d")) for a, b in steps])).alias("s"))
    grown = near.select((F.col("row") + F.col("s.a")).alias("row"), (F.col("col") + F.col("s.b")).alias("col"), "s.d", "label").groupBy("row", "col").agg(F.min(F.struct("d", "label")).alias("m"))
    return grown.filter((F.col("row") >= 0) & (F.col("row") < shape[0]) & (F.col("col") >= 0) & (F.col("col") < shape[1])).select("row", "col", F.col("m.label").alias("label"))


def remap(labels: DataFrame, ids: DataFrame) -> DataFrame:
    """Labels exchanged by ids(label, new_label); unknown ones become background."""
    return labels.join(ids, "label", "left").select("row", "col", F.coalesce("new_label", F.lit(0)).alias("label"))


def components(mask: DataFrame) -> DataFrame:
    """Connected components (four neighbours) of a mask: (row, col, component), numbered by their least run.

    Works on runs: those of adjacent rows that touch are the edges of a graph.
    """
    base = cut(runs(mask).withColumn("id", F.xxhash64("row", "col_start")))
    a, b = base.alias("a"), base.alias("b")
    touch = a.join(b, (F.col("a.row") + 1 == F.col("b.row")) & (F.col("a.col_start") <= F.col("b.col_end")) & (F.col("b.col_start") <= F.col("a.col_end"))).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))
    comp = base.select("id").join(connected(touch), "id", "left").select("id", F.coalesce("component", "id").alias("c"))
    return base.join(comp, "id").select("row", F.explode(F.sequence("col_start", "col_end")).alias("col"), F.col("c").alias("component"))


def large_components(labelled: DataFrame, least: int) -> DataFrame:
    """Pixels of components with at least so many pixels."""
    big = labelled.groupBy("component").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return labelled.join(big, "component", "left_semi").select("row", "col")


def fill_holes(mask: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """The mask with every background component that does not reach the border."""
    spark = mask.sparkSession
    everything = spark.range(shape[0]).select(F.col("id").cast("int").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(shape[1] - 1))).alias("col"))
    back = components(everything.join(mask, ["row", "col"], "left_anti"))
    border = back.filter((F.col("row") == 0) | (F.col("col") == 0) | (F.col("row") == shape[0] - 1) | (F.col("col") == shape[1] - 1)).select("component").distinct()
    return mask.select("row", "col").unionByName(back.join(border, "component", "left_anti").select("row", "col"))
