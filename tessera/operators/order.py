"""Dense numbers for sorted rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut

_WITHIN = (1 << 33) - 1  # monotonically_increasing_id counts the rows of a partition in these bits


def numbered(rows: DataFrame, name: str, *order: str, start: int = 1) -> DataFrame:
    """rows with an int column of dense numbers in the order of these columns, which should tell all rows apart.

    Rows are dealt by ranges and counted per range, so that no task sees all of
    them; only one row per range is summed up in order.
    """
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)).alias("_at")))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return placed.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_at") + start).cast("int")).drop("_part", "_at", "_before")
