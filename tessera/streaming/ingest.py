"""Incremental ingestion: files of reads as a stream, molecules kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_tables(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder as they arrive; the query's checkpoint remembers which were read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def count_stream(reads: DataFrame) -> DataFrame:
    """Running reads per molecule of a stream(barcode, gene, umi)."""
    return reads.groupBy("barcode", "gene", "umi").agg(F.count("*").alias("cnt"))


def distinct_lanes(reads: DataFrame, key: list[str], time: str, delay: str = "1 hour") -> DataFrame:
    """A stream without repeats of a key within the watermark."""
    return reads.withWatermark(time, delay).dropDuplicatesWithinWatermark(key)


def windowed_counts(events: DataFrame, time: str, window: str, delay: str, by: list[str]) -> DataFrame:
    """Counts per tumbling window and key, closed by the watermark."""
    return events.withWatermark(time, delay).groupBy(F.window(time, window).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def upsert_molecules(path: str):
    """A foreachBatch sink that adds a batch's counts to a partitioned table of increments; readers sum them.

    Each batch writes its own folder, so replaying it after a failure overwrites
    and never counts twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.groupBy("barcode", "gene", "umi").agg(F.count("*").alias("cnt")).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_molecules(spark: SparkSession, path: str) -> DataFrame:
    """Molecules summed over all batches written."""
    return spark.read.parquet(path).groupBy("barcode", "gene", "umi").agg(F.sum("cnt").alias("cnt"))
