"""Final ordering of the score tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def rank_by_score(df: DataFrame, score_col: str = "weighted_score") -> DataFrame:
    """Score descending with NULL scores last, then every other column ascending.

    The original sorts only by score (ties keep the phone order of the
    preceding merge); the remaining columns make the order total, so equal
    inputs give byte-identical outputs.  This is one range-partitioned sort of
    the (lead-sized) result.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != score_col]
    return df.orderBy(F.col(score_col).desc_nulls_last(), *rest)


def with_position(df: DataFrame, score_col: str = "weighted_score") -> DataFrame:
    """Add ``position``: 1 for the first row by :func:`rank_by_score`, and so on.

    The sorted ranges are numbered on their own; only their sizes, one row for
    each range, are summed in order.
    """
    checkpoint_dir(df.sparkSession)
    placed = rank_by_score(df, score_col).withColumn("_at", F.monotonically_increasing_id()).checkpoint(eager=True)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
            .withColumn("position", F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1)
            .drop("_part", "_start", "_at"))
