"""The corpus pipeline: stages that each read what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import Stages, table
from tessera.llm.decontaminate import drop_contaminated
from tessera.llm.exact_dedup import drop_exact_copies
from tessera.llm.language_id import keep_identified, train
from tessera.llm.near_dedup import drop_near_copies
from tessera.llm.packing import pack


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be told: null texts, texts without a letter or of no learnt language."""
    return keep_identified(docs, train(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the largest id of each group of equal texts; of texts that no id has, all rows stay together."""
    return drop_exact_copies(docs, keep="max")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the least id of each group of texts similar at 0.8 or more; texts without words stay."""
    return drop_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage like a benchmark item, each row by its own text."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the documents into batches of similar lengths; every row has its place."""
    return pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("packing", packing_stage),
]

#: SQL cannot express language identification by trained filters nor the choice of buckets.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages, docs = Stages(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stages.keep(stage(spark, docs, sf_dir), name)
    return docs
