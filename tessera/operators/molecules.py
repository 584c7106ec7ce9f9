"""From aligned reads to molecules: UMI merging, multi-gene resolution, per-barcode summaries."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut
from .order import numbered


def count_molecules(alignments: DataFrame) -> DataFrame:
    """(barcode, gene, umi, cnt) from alignments(query_name = barcode_umi_..., gene); reads without a gene are dropped."""
    parts = F.split("query_name", "_")
    return alignments.filter("gene is not null").select(parts[0].alias("barcode"), "gene", parts[1].alias("umi")).groupBy("barcode", "gene", "umi").agg(F.count("*").alias("cnt"))


def merge_parents(molecules: DataFrame, width: int, ratio: float = 0.1) -> DataFrame:
    """Each UMI's merge target within its barcode and gene, or null.

    The target is the highest by (count, sequence) among UMIs one base away whose
    count is at least 1/ratio times as high.  Neighbours meet on wildcard
    patterns, so there is no quadratic self-join.
    """
    patterns = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.overlay(F.col("umi"), F.lit("_"), F.lit(i + 1), F.lit(1)).alias("p")) for i in range(width)])).alias("w")
    spread = molecules.select("barcode", "gene", "umi", "cnt", patterns).select("barcode", "gene", "umi", "cnt", "w.i", "w.p")
    keys = ["barcode", "gene", "i", "p"]
    other = spread.select(*keys, F.col("umi").alias("v"), F.col("cnt").alias("vcnt"))
    near = spread.join(other, keys).filter(F.col("umi") != F.col("v")).filter(F.col("cnt") / F.col("vcnt") <= ratio)
    best = near.groupBy("barcode", "gene", "umi").agg(F.max(F.struct("vcnt", "v")).alias("t")).select("barcode", "gene", "umi", F.col("t.v").alias("parent"))
    return molecules.join(best, ["barcode", "gene", "umi"], "left")


def merge_umis(molecules: DataFrame, width: int, ratio: float = 0.1) -> DataFrame:
    """Molecules after directional merging, with the number of UMIs and reads that each took in.

    Every hop needs a count 1/ratio times as high, so a chain of 64-bit counts has
    at most log(2**63) / log(1 / ratio) hops, and pointer doubling follows them
    all.  A ratio of 1 or more has no such bound and is an error.
    """
    if not 0 < ratio < 1:
        raise ValueError("the ratio lies between 0 and 1")
    rounds = math.ceil(math.log2(63 * math.log(2) / -math.log(ratio) + 1))
    keys = ["barcode", "gene"]
    # only merged UMIs take part in the doubling; each step is written, else it would be computed twice by the next
    hop = cut(merge_parents(molecules, width, ratio).filter("parent is not null").select(*keys, "umi", F.col("parent").alias("root")))
    for _ in range(rounds):
        up = hop.select(*keys, F.col("umi").alias("root"), F.col("root").alias("next"))
        step = cut(hop.join(up, [*keys, "root"], "left").select(*keys, "umi", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        hop = step.drop("moved")
        if step.filter("moved").isEmpty():
            break
    now = molecules.join(hop, [*keys, "umi"], "left").select(*keys, "umi", "cnt", F.coalesce("root", "umi").alias("root"))
    merged = F.col("umi") != F.col("root")
    return now.groupBy(*keys, F.col("root").alias("umi")).agg(
        F.sum("cnt").alias("cnt"), F.count_if(merged).alias("merged_umis"), F.coalesce(F.sum(F.when(merged, F.col("cnt"))), F.lit(0)).alias("merged_reads")
    )


def resolve_genes(molecules: DataFrame) -> DataFrame:
    """Keep, per barcode and UMI, the gene with the most reads; drop the UMI where that is a tie."""
    w = Window.partitionBy("barcode", "umi")
    ranked = molecules.withColumn("_top", F.max("cnt").over(w))
    return ranked.withColumn("_ties", F.count_if(F.col("cnt") == F.col("_top")).over(w)).filter("cnt = _top and _ties = 1").drop("_top", "_ties")


def barcode_summary(molecules: DataFrame) -> DataFrame:
    """Per barcode: reads, reads of molecules seen more than once (umi2), molecules, genes."""
    return molecules.groupBy("barcode").agg(
        F.sum("cnt").alias("readcount"), F.coalesce(F.sum(F.when(F.col("cnt") > 1, F.col("cnt"))), F.lit(0)).alias("umi2"), F.count("*").alias("umi"), F.count_distinct("gene").alias("genes")
    )


def distinct_umi_summary(molecules: DataFrame) -> DataFrame:
    """The report's fallback: distinct UMI sequences per barcode instead of molecules."""
    return molecules.groupBy("barcode").agg(F.count_distinct("umi").alias("umis"), F.sum("cnt").alias("readcount"))


def gene_matrix(molecules: DataFrame, features: DataFrame) -> DataFrame:
    """Sparse matrix of molecules per gene and barcode, as 1-based triplets.

    features(gene, feature_idx) keeps all annotated genes; a gene without a row
    there is an error.  Barcodes are numbered in lexical order.
    """
    values = molecules.groupBy("barcode", "gene").agg(F.count("*").alias("value"))
    barcodes = numbered(molecules.select("barcode").distinct(), "barcode_idx", "barcode")
    known = values.join(features, "gene", "left").withColumn("feature_idx", F.when(F.col("feature_idx").isNull(), F.raise_error(F.concat(F.lit("unknown gene "), F.col("gene"))).cast("int")).otherwise(F.col("feature_idx")))
    return known.join(barcodes, "barcode").select("feature_idx", "barcode_idx", "value")
