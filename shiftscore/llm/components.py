"""Connected components of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftscore.llm.common import keep


def _to_least(pairs: DataFrame, both_sides: bool) -> DataFrame:
    """Links from each neighbour of ``a`` (of each side, or the smaller ones) to the least of them and ``a``."""
    least = pairs.groupBy("a").agg(F.min("b").alias("_least")).withColumn("_least", F.least("a", "_least"))
    joined = pairs.join(least.withColumnRenamed("a", "_a"), F.col("a") == F.col("_a"))
    if both_sides:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("_least").alias("b")).union(
            least.select("a", F.col("_least").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``): the least node that can be reached.

    Each round is a few joins and partial minima; a node with many links is
    never gathered, and no link comes to the driver, only a count and a sum to
    see whether the round has changed anything.  Links of a node to itself are
    allowed and say nothing; nodes without other links are not returned.
    """
    pairs = keep(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        seen = state
        large = _to_least(pairs.union(pairs.select("b", "a")), True)
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        pairs = keep(_to_least(down, False))
