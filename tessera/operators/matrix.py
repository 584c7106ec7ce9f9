"""Sparse count matrices as three relations: algebra, and the filter of a bin folder by a mask."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .order import numbered
from .spatial import remove_in_mask


@dataclass(frozen=True)
class Matrix:
    """features(feature_idx, gene, name), barcodes(barcode_idx, barcode), values(feature_idx, barcode_idx, value); indexes from 1."""

    features: DataFrame
    barcodes: DataFrame
    values: DataFrame


def _first(rows: DataFrame, column: str, n: int = 5) -> str:
    return ", ".join(str(r[0]) for r in rows.select(column).orderBy(column).limit(n).collect())


def concat_features(a: Matrix, b: Matrix) -> Matrix:
    """The features of b below those of a.  Barcodes must agree in number, order and name, and no gene may be in both."""
    differ = a.barcodes.join(b.barcodes.withColumnRenamed("barcode", "other"), "barcode_idx", "full").filter(~F.col("barcode").eqNullSafe(F.col("other")))
    if not differ.isEmpty():
        raise ValueError("the barcodes are not the same")
    both = a.features.join(b.features, "gene", "left_semi")
    if not both.isEmpty():
        raise ValueError(f"genes in both: {_first(both, 'gene')}")
    n = a.features.agg(F.coalesce(F.max("feature_idx"), F.lit(0)).cast("int")).first()[0]
    shift = (F.col("feature_idx") + n).alias("feature_idx")
    return Matrix(a.features.unionByName(b.features.select(shift, "gene", "name")), a.barcodes, a.values.unionByName(b.values.select(shift, "barcode_idx", "value")))


def slice_barcodes(m: Matrix, wanted: DataFrame) -> Matrix:
    """The columns wanted(position, barcode_idx), in the order of position, each as often as it is wanted; an unknown one is an error."""
    lost = wanted.join(m.barcodes, "barcode_idx", "left_anti")
    if not lost.isEmpty():
        raise IndexError(f"no barcodes {_first(lost, 'barcode_idx')}")
    new = numbered(wanted.select("position", "barcode_idx"), "new_idx", "position")
    barcodes = new.join(m.barcodes, "barcode_idx").select(F.col("new_idx").alias("barcode_idx"), "barcode")
    values = m.values.join(new, "barcode_idx").select("feature_idx", F.col("new_idx").alias("barcode_idx"), "value")
    return Matrix(m.features, barcodes, values)


def common_barcodes(a: DataFrame, b: DataFrame) -> DataFrame:
    """The sorted distinct barcodes of both, with their indexes in each: (barcode, a_idx, b_idx); of repeats the first counts."""
    first = [df.groupBy("barcode").agg(F.min("barcode_idx").alias(f"{k}_idx")) for df, k in ((a, "a"), (b, "b"))]
    return first[0].join(first[1], "barcode")


def require_positions(barcodes: DataFrame, positions: DataFrame) -> None:
    """An error that says how many barcodes have no position."""
    n = barcodes.join(positions, "barcode", "left_anti").count()
    if n:
        raise ValueError(f"{n} barcodes are missing from the positions")


def filter_by_mask(m: Matrix, positions: DataFrame, mask: DataFrame, radius: int = 0) -> tuple[Matrix, DataFrame, DataFrame]:
    """(matrix, positions, summary) without the barcodes whose surroundings touch the mask.

    Every barcode needs a position; those outside the raster stay.  Kept barcodes
    are renumbered in their order.  summary: total_barcodes, kept_barcodes,
    removed_barcodes, removed_fraction (0 without barcodes).
    """
    require_positions(m.barcodes, positions)
    stay = remove_in_mask(positions, mask, radius)
    kept = numbered(m.barcodes.join(stay.select("barcode").distinct(), "barcode", "left_semi").select("barcode_idx", "barcode"), "new_idx", "barcode_idx")
    out = Matrix(m.features, kept.select(F.col("new_idx").alias("barcode_idx"), "barcode"), m.values.join(kept, "barcode_idx").select("feature_idx", F.col("new_idx").alias("barcode_idx"), "value"))
    n, k = m.barcodes.agg(F.count("*").alias("total_barcodes")), kept.agg(F.count("*").alias("kept_barcodes"))
    gone = F.col("total_barcodes") - F.col("kept_barcodes")
    summary = n.crossJoin(k).select("*", gone.alias("removed_barcodes"), F.coalesce(F.try_divide(gone, F.col("total_barcodes")), F.lit(0.0)).alias("removed_fraction"))
    return out, stay.join(kept.select("barcode"), "barcode", "left_semi"), summary
