"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.common import cut


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its lowest node) for all nodes of ``edges`` (a, b).

    Each round hangs the neighbours of a node on the lowest one, first the higher neighbours,
    then the lower ones, until all are stars. The number of rounds grows with the logarithm of
    the longest chain; a round is two aggregations and two joins over edges, and is checkpointed.
    """
    current = cut(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.join(lowest, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")),
        )).alias("e")).select("e.*").where(F.col("a") != F.col("b")).distinct()
        current = cut(small)
        now = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)
