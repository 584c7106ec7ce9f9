"""Exact deduplication: DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages, ascii_lower, join_groups


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """Label every row with the copy that stays.

    Rows are grouped by the 128-bit hash of the normalised text (A-Z lowered)
    together with its bytes: the hash spreads the groups, and the aggregate
    compares the bytes of rows with equal hashes, so a collision cannot merge
    different texts.  Partial aggregation folds a group of any size before the
    shuffle.  keep is "min" or "max": which id of a group stays.

    Null text counts as empty; a null id never wins against a present one; rows
    repeating both id and text share the same outcome.  Returns id_col, keep_id,
    group_size, kept, text_sha256, one row per input row.
    """
    if keep not in ("min", "max"):
        raise ValueError("keep must be min or max")
    stages = Stages(docs.sparkSession, "exact")
    norm = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.col(text_col)).alias("norm"))
    groups = (
        norm.select("doc_id", F.unhex(F.md5("norm")).alias("h"), "norm")
        .groupBy("h", "norm")
        .agg(getattr(F, keep)("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select(F.concat("h", F.unhex(F.sha2("norm", 256))).alias("key"), "keep_id", "group_size")
    )
    groups = stages.keep(groups, "groups")
    light = stages.keep(norm.select("doc_id", F.concat(F.unhex(F.md5("norm")), F.unhex(F.sha2("norm", 256))).alias("key")), "rows")
    out = join_groups(light, groups, "key", "group_size", light.count())
    return out.select(
        F.col("doc_id").alias(id_col), "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex(F.substring("key", 17, 32))).alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame, keep: str = "max") -> DataFrame:
    """The rows of docs that stay, whole and with their columns.

    Rows that repeat both id and text stay together; of rows without an id, one
    group of equal texts stays if no row with an id has that text.
    """
    norm = ascii_lower(F.col("text"))
    best = docs.select("doc_id", norm.alias("norm")).groupBy(F.unhex(F.md5("norm")).alias("_h"), "norm").agg(getattr(F, keep)("doc_id").alias("_keep")).select("_h", "_keep")
    same = F.unhex(F.md5(ascii_lower(docs["text"]))) == best["_h"]
    return docs.join(best, same & docs["doc_id"].eqNullSafe(best["_keep"]), "left_semi")
