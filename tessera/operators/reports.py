"""Tables behind the reports: curves brought to one scale, pivots, matrix statistics, attached metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def normalise_curve(curve: DataFrame) -> DataFrame:
    """curve(line, read_fraction, saturation) as fractions of 0..1 and percents of 0..100, the last line of each fraction.

    Fractions given in percent (greatest above 1.5) are divided by 100,
    saturations given as shares (greatest at most 1) multiplied; what is no
    number drops out.
    """
    rows = curve.select("line", F.col("read_fraction").try_cast("double").alias("f"), F.col("saturation").try_cast("double").alias("s")).filter("f is not null and s is not null")
    top = rows.agg(F.max("f").alias("mf"), F.max("s").alias("ms"))
    f = F.when(F.col("mf") > 1.5, F.col("f") / 100).otherwise(F.col("f"))
    s = F.when(F.col("ms") <= 1, F.col("s") * 100).otherwise(F.col("s"))
    scaled = rows.crossJoin(F.broadcast(top)).select("line", F.greatest(F.lit(0.0), F.least(F.lit(1.0), f)).alias("read_fraction"), F.greatest(F.lit(0.0), F.least(F.lit(100.0), s)).alias("saturation"))
    return scaled.groupBy("read_fraction").agg(F.max_by("saturation", "line").alias("saturation"))


def pivot_metrics(stats: DataFrame, wanted: list[str]) -> DataFrame:
    """stats(bin, key, value) with one row per bin and one column per wanted key, and its place: numbers, other names, Raw last."""
    wide = stats.groupBy("bin").pivot("key", wanted).agg(F.first("value"))
    number = F.col("bin").try_cast("int")
    return wide.withColumn("place", F.row_number().over(Window.orderBy(F.lower("bin") == "raw", number.isNull(), number, "bin")))


def matrix_stats(triplets: DataFrame) -> DataFrame:
    """One row of triplets(bin, gene, value): bins, genes, entries, means and medians per bin."""
    per = triplets.filter("value > 0").groupBy("bin").agg(F.sum("value").alias("u"), F.count("*").alias("g"))
    genes = triplets.filter("value > 0").agg(F.count_distinct("gene").alias("genes"), F.count("*").alias("entries"))
    out = per.agg(F.count("*").alias("bins"), F.round(F.avg("u"), 6).alias("mean_umi"), F.median("u").alias("median_umi"), F.round(F.avg("g"), 6).alias("mean_genes"), F.median("g").alias("median_genes"))
    return out.crossJoin(genes)


def attach_metadata(cells: DataFrame, metadata: DataFrame) -> DataFrame:
    """Cells with the first complete coordinate pair of metadata(line, barcode, x1, y1, x2, y2); 0 and has_spatial false without one."""
    first = metadata.groupBy("barcode").agg(F.min_by(F.struct("x1", "y1", "x2", "y2"), "line").alias("m"))
    one = F.col("m.x1").isNotNull() & F.col("m.y1").isNotNull()
    two = F.col("m.x2").isNotNull() & F.col("m.y2").isNotNull()

    def pick(a, b):
        return F.when(one, F.col(f"m.{a}")).when(two, F.col(f"m.{b}")).otherwise(F.lit(0.0))

    return cells.join(first, "barcode", "left").select(*cells.columns, pick("x1", "x2").alias("x"), pick("y1", "y2").alias("y"), F.coalesce(one | two, F.lit(False)).alias("has_spatial"))


def coordinate_step(positions: DataFrame, column: str, q: float = 0.1) -> DataFrame:
    """One row: a low quantile of the gaps between consecutive distinct coordinates."""
    distinct = positions.select(column).distinct()
    gap = F.lead(column).over(Window.orderBy(column)) - F.col(column)
    return distinct.select(gap.alias("g")).agg(F.percentile("g", F.lit(q)).alias("step"))


def robust_levels(values: DataFrame, column: str) -> DataFrame:
    """log1p of a column stretched from its 1st to its 99.5th percentile to 0..255."""
    v = values.withColumn("_v", F.log1p(column))
    q = v.agg(F.percentile("_v", F.lit(0.01)).alias("lo"), F.percentile("_v", F.lit(0.995)).alias("hi"))
    share = F.coalesce(F.try_divide(F.col("_v") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(0.0))
    return v.crossJoin(F.broadcast(q)).withColumn("level", F.bround(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)) * 255, 6), 0).cast("int")).drop("_v", "lo", "hi")


def cell_depths(molecules: DataFrame, cells: DataFrame) -> DataFrame:
    """Reads, molecules and genes of every called cell, 0 for those without any."""
    per = molecules.groupBy("barcode").agg(F.sum("cnt").alias("reads"), F.count("*").alias("umi"), F.count_distinct("gene").alias("genes"))
    return cells.select("barcode").distinct().join(per, "barcode", "left").fillna(0, ["reads", "umi", "genes"])


def exonic_split(summary: DataFrame) -> DataFrame:
    """One row of summary(status, n): exonic, intergenic, ambiguous and, as the rest of the total, intronic reads."""
    def n(status: str):
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("n"))), F.lit(0))

    parts = summary.agg(F.sum("n").alias("total"), n("Assigned").alias("exonic"), n("Unassigned_NoFeatures").alias("intergenic"), n("Unassigned_Ambiguity").alias("ambiguous"))
    return parts.withColumn("intronic", F.col("total") - F.col("exonic") - F.col("intergenic") - F.col("ambiguous"))


def retained_summary(cells: DataFrame) -> DataFrame:
    """One row over retained cells, over all cells where none is: mean reads, median area, median barcodes per cell.

    cells(retained, reads, area_px, assigned_barcodes); values that are no numbers do not count.
    """
    kept = F.coalesce(F.col("retained").try_cast("double"), F.lit(0.0)) > 0
    any_kept = cells.agg(F.coalesce(F.bool_or(kept), F.lit(False)).alias("_any"))
    rows = cells.crossJoin(F.broadcast(any_kept)).filter(kept | ~F.col("_any"))
    value = {c: F.col(c).try_cast("double") for c in ("reads", "area_px", "assigned_barcodes")}
    return rows.agg(F.avg(value["reads"]).alias("mean_reads_per_cell"), F.median(value["area_px"]).alias("median_cell_area_px2"), F.median(value["assigned_barcodes"]).alias("median_barcodes_per_cell"))


def bin_tissue(pixels: DataFrame) -> DataFrame:
    """Per bin of pixels(bin, in_tissue): whether any of it lies in tissue."""
    return pixels.groupBy("bin").agg(F.coalesce(F.bool_or(F.col("in_tissue").cast("boolean")), F.lit(False)).alias("in_tissue"))


def bin_report(located: DataFrame, label: Column, exonic_reads: int) -> DataFrame:
    """One row over labelled bins: bins, reads, matched and unmatched rows, means and medians, and the share of exonic reads in bins.

    located(gene, umi, cnt, x, ...): rows without a position have no bin and
    count as unmatched.  Reads of a molecule that falls into one bin several times add up.
    """
    rows = located.withColumn("_bin", label)
    lost = rows.agg(F.count_if(F.col("_bin").isNull()).alias("unmatched_rows"), F.coalesce(F.sum("cnt"), F.lit(0)).alias("all_reads"))
    molecules = rows.filter("_bin is not null").groupBy("_bin", "barcode", "gene", "umi").agg(F.sum("cnt").alias("cnt")).filter("cnt > 0")
    per = molecules.groupBy("_bin").agg(F.sum("cnt").alias("readcount"), F.count("*").alias("umi"), F.count_distinct("gene").alias("genes"))
    stats = per.agg(
        F.count("*").alias("bins"), F.coalesce(F.sum("readcount"), F.lit(0)).alias("reads_in_bins"), F.median("umi").alias("median_umi"), F.median("genes").alias("median_genes"), F.round(F.avg("umi"), 6).alias("mean_umi"),
    )
    return stats.crossJoin(lost).withColumn("exonic_share", F.round(F.try_divide(F.col("reads_in_bins"), F.lit(exonic_reads).cast("double")), 6))
