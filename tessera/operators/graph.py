"""Connected components of a relation of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut


def connected(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of edges(a, b); the component is its least node.

    Each round hangs the greater neighbours of every node, then all of its lesser
    ones, on the least node it knows; edges end as stars around the least nodes,
    after a number of rounds that grows with the logarithm of the longest path.
    """
    now, before = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        known = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        up = both.filter("b > a").join(known, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = up.groupBy("a").agg(F.min("b").alias("m"))
        down = up.join(lowest, "a").select("a", "m", "b")
        now = cut(down.select("a", F.col("m").alias("b")).unionByName(down.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        before = state
