"""Positions, bins, masks and labelled cells as relations."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.seq import grid_barcode
from .order import numbered


def with_positions(molecules: DataFrame, positions: DataFrame) -> DataFrame:
    """Molecules at known positions; Spark broadcasts the positions only while they are small."""
    return molecules.join(positions, "barcode")


def canvas(positions: DataFrame, raster_shape: tuple[int, int] | None = None) -> DataFrame:
    """One row (height, width): the greater of the raster's shape and the last coordinate plus one."""
    h, w = raster_shape or (0, 0)
    return positions.agg(F.greatest(F.lit(h), F.ceil(F.max("y")) + 1).alias("height"), F.greatest(F.lit(w), F.ceil(F.max("x")) + 1).alias("width"))


def bin_pixels(microns: int, pixel_size: float) -> int:
    return math.ceil(microns / pixel_size)


def square_bins(located: DataFrame, width: int, height: int, microns: tuple[int, ...] = (10, 20, 50, 100), pixel_size: float = 0.5) -> DataFrame:
    """Rows of located(x, y, ...) once per bin size, with bin_um, bin_row, bin_col and the bin's barcode.

    All sizes come from one explode, so the facts are scanned and shuffled once;
    rows outside the grid drop out.
    """
    sizes = [(m, bin_pixels(m, pixel_size)) for m in microns]
    each = located.withColumn("_s", F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.lit(p).alias("p")) for m, p in sizes])))
    out = each.withColumn("bin_um", F.col("_s.m")).withColumn("bin_row", F.floor(F.col("y") / F.col("_s.p")).cast("int")).withColumn("bin_col", F.floor(F.col("x") / F.col("_s.p")).cast("int"))
    out = out.filter((F.col("x") >= 0) & (F.col("y") >= 0) & (F.col("x") < width) & (F.col("y") < height))
    name = F.lit(None).cast("string")
    for m, p in sizes:
        name = F.when(F.col("bin_um") == m, grid_barcode(F.col("bin_row"), F.col("bin_col"), math.ceil(width / p), math.ceil(height / p))).otherwise(name)
    return out.withColumn("bin", name).drop("_s")


def bin_summary(binned: DataFrame) -> DataFrame:
    """Per bin: reads, molecules, molecules seen more than once (a count here), genes."""
    return binned.groupBy("bin_um", "bin_row", "bin_col").agg(F.sum("cnt").alias("readcount"), F.count_if(F.col("cnt") > 1).alias("umi2"), F.count("*").alias("umi"), F.count_distinct("gene").alias("genes"))


def bin_stats(binned: DataFrame) -> DataFrame:
    """Per bin size: bins, truncated means and medians over bins, genes."""
    per = bin_summary(binned).groupBy("bin_um").agg(
        F.count("*").alias("bins"), F.floor(F.sum("readcount") / F.count("*")).cast("int").alias("mean_reads"), F.avg("umi").cast("int").alias("mean_umi"), F.median("umi").cast("int").alias("median_umi"),
        F.avg("genes").cast("int").alias("mean_genes"), F.median("genes").cast("int").alias("median_genes"),
    )
    return per.join(binned.groupBy("bin_um").agg(F.count_distinct("gene").alias("total_genes")), "bin_um")


def bin_in_tissue(bins: DataFrame, mask: DataFrame, width: int, height: int, pixel_size: float = 0.5) -> DataFrame:
    """Distinct bins with in_tissue (is the bin's centre foreground) and the centre's pixel."""
    p = F.ceil(F.col("bin_um") / pixel_size)

    def centre(c: str, most: int) -> Column:
        return F.least(F.lit(most - 1), ((F.col(c) + 0.5) * p).cast("int"))

    at = bins.select("bin_um", "bin_row", "bin_col").distinct().withColumn("row", centre("bin_row", height)).withColumn("col", centre("bin_col", width))
    return at.join(mask.withColumn("in_tissue", F.lit(1)), ["row", "col"], "left").select("bin_um", "bin_row", "bin_col", F.col("row").alias("pxl_row"), F.col("col").alias("pxl_col"), F.coalesce("in_tissue", F.lit(0)).alias("in_tissue"))


def scaled(raw: Column, origin: float, extent: float, pixels: int, rounding: str = "floor") -> Column:
    """A raw coordinate on the pixel grid."""
    v = (raw - origin) * (pixels / extent)
    return (F.floor(v) if rounding == "floor" else F.bround(v, 0)).cast("int")


def on_grid(positions: DataFrame, box: tuple[float, float, float, float], shape: tuple[int, int], rounding: str = "floor") -> DataFrame:
    """positions(x, y) with row, col and in_bounds for a box (x0, y0, width, height) over a raster of (rows, cols)."""
    x0, y0, w, h = box
    out = positions.withColumn("row", scaled(F.col("y"), y0, h, shape[0], rounding)).withColumn("col", scaled(F.col("x"), x0, w, shape[1], rounding))
    inside = (F.col("row") >= 0) & (F.col("row") < shape[0]) & (F.col("col") >= 0) & (F.col("col") < shape[1])
    return out.withColumn("in_bounds", F.coalesce(inside, F.lit(False)))


def keep_in_mask(positions: DataFrame, mask: DataFrame, box, shape, invert: bool = False) -> DataFrame:
    """Positions whose pixel is foreground (or is not, inverted); those out of bounds are dropped."""
    at = on_grid(positions, box, shape).filter("in_bounds")
    return at.join(mask, ["row", "col"], "left_anti" if invert else "left_semi").select(*positions.columns)


def remove_in_mask(positions: DataFrame, mask: DataFrame, radius: int = 0) -> DataFrame:
    """Positions without a mask pixel in the square around their rounded pixel (half to even); those out of bounds stay."""
    near = mask
    if radius:
        shifts = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1)])).alias("s")
        near = mask.select("row", "col", shifts).select((F.col("row") + F.col("s.a")).alias("row"), (F.col("col") + F.col("s.b")).alias("col")).distinct()
    at = positions.withColumn("row", F.bround(F.col("y").cast("double"), 0).cast("int")).withColumn("col", F.bround(F.col("x").cast("double"), 0).cast("int"))
    return at.join(near, ["row", "col"], "left_anti").select(*positions.columns)


def assign_labels(positions: DataFrame, labels: DataFrame, box, shape, rounding: str = "floor") -> DataFrame:
    """positions with row, col, in_bounds and the label of their pixel, 0 outside or on background."""
    return on_grid(positions, box, shape, rounding).join(labels.filter("label <> 0"), ["row", "col"], "left").withColumn("cell_id", F.coalesce("label", F.lit(0))).drop("label")


def label_runs(labels: DataFrame) -> DataFrame:
    """A label raster as runs (row, col_start, col_end, label) of equal non-zero labels."""
    w = Window.partitionBy("row").orderBy("col")
    edge = (F.lag("label").over(w).isNull()) | (F.lag("label").over(w) != F.col("label")) | (F.lag("col").over(w) + 1 != F.col("col"))
    runs = labels.withColumn("run", F.sum(F.when(edge, 1).otherwise(0)).over(w))
    return runs.filter("label <> 0").groupBy("row", "run", "label").agg(F.min("col").alias("col_start"), F.max("col").alias("col_end")).drop("run")


def label_geometry(labels: DataFrame, box, shape) -> DataFrame:
    """Per label: area, centroid in pixels, centroid at full resolution."""
    x0, y0, w, h = box
    return labels.filter("label <> 0").groupBy("label").agg(F.count("*").alias("area_px"), F.avg("row").alias("r"), F.avg("col").alias("c")).select(
        "label", "area_px", F.round("r", 6).alias("centroid_row_px"), F.round("c", 6).alias("centroid_col_px"),
        F.round((F.col("r") + 0.5) * (h / shape[0]) + y0, 6).alias("pxl_row_in_fullres"), F.round((F.col("c") + 0.5) * (w / shape[1]) + x0, 6).alias("pxl_col_in_fullres"),
    )


def per_cell_barcodes(assigned: DataFrame) -> DataFrame:
    """Number of barcodes of each cell."""
    return assigned.filter("cell_id <> 0").groupBy("cell_id").agg(F.count("*").alias("assigned_barcodes"))


def assignment_summary(assigned: DataFrame) -> DataFrame:
    """One row: barcodes, in-bounds and assigned shares to six places, quantiles of barcodes per cell."""
    n = F.count("*")
    rates = assigned.agg(n.alias("barcodes"), F.bround(F.count_if("in_bounds") / n, 6).alias("in_bounds_rate"), F.bround(F.count_if(F.col("cell_id") != 0) / n, 6).alias("assigned_rate"))
    q = per_cell_barcodes(assigned).agg(*[F.percentile("assigned_barcodes", F.lit(p)).alias(f"q{int(p * 100)}") for p in (0.1, 0.25, 0.5, 0.75, 0.9)])
    return rates.crossJoin(q)


def cell_counts(molecules: DataFrame, assigned: DataFrame) -> DataFrame:
    """Per segmented cell: molecules, reads, genes; a barcode assigned twice counts once, for its least cell."""
    of = assigned.filter("cell_id <> 0").groupBy("barcode").agg(F.min("cell_id").alias("cell_id"))
    return molecules.join(of, "barcode").groupBy("cell_id").agg(F.count("*").alias("umi"), F.sum("cnt").alias("reads"), F.count_distinct("gene").alias("genes"))


def retained_cells(counts: DataFrame, least_umi: int = 1, least_genes: int = 1, most_umi: int = 0) -> DataFrame:
    """Cells that pass, renumbered densely by their raw id; most_umi of 0 is no limit."""
    keep = (F.col("umi") >= least_umi) & (F.col("genes") >= least_genes)
    if most_umi:
        keep = keep & (F.col("umi") <= most_umi)
    return numbered(counts.filter(keep), "new_cell_id", "cell_id")


def heatmap(located: DataFrame, pixels: int, q: float = 0.05) -> DataFrame:
    """Molecules per square of the canvas, with the noise floor (a low quantile of the squares) and whether above it."""
    grid = located.groupBy(F.floor(F.col("y") / pixels).cast("int").alias("row_bin"), F.floor(F.col("x") / pixels).cast("int").alias("col_bin")).agg(F.count("*").alias("umi"))
    floor = grid.agg(F.percentile("umi", F.lit(q)).alias("floor"))
    return grid.crossJoin(F.broadcast(floor)).withColumn("above", F.col("umi") > F.col("floor"))


def bin_label(x: Column, y: Column, microns: int = 10, pixel_size: float = 0.5) -> Column:
    """bin10_{column}_{row} labels of the single-cell report."""
    w = bin_pixels(microns, pixel_size)
    return F.concat_ws("_", F.lit(f"bin{microns}"), F.floor(x / w).cast("string"), F.floor(y / w).cast("string"))


def greedy_spaced(cells: DataFrame, n: int, distance: float) -> list[tuple]:
    """Ids of at most n cells by molecules (ties by id), each over ``distance`` from all chosen before.

    The sorted cells are read piece by piece until n are chosen.
    """
    chosen: list[tuple] = []
    for r in cells.orderBy(F.desc("umi"), "cell_id").toLocalIterator():
        if len(chosen) == n:
            break
        if all(math.hypot(r["x"] - x, r["y"] - y) > distance for _, x, y in chosen):
            chosen.append((r["cell_id"], r["x"], r["y"]))
    return [c for c, _, _ in chosen]
