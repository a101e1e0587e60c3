"""Top-1 row per group without bringing a group into one task.

``DISTINCT ON (keys) ... ORDER BY`` is ``row_number() = 1``, which Spark plans
as a group limit on both sides of the shuffle: each map task passes on one row
per key, so a key with a third of all rows is no larger there than any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_group(df: DataFrame, keys: list[str], order: list[str], values: list[str],
                    descending: bool) -> DataFrame:
    """One row per ``keys``: the first by ``order``, all DESC or all ASC, ties broken by ``values``.

    NULLs as in PostgreSQL: first for DESC, last for ASC.  Returns ``keys + values``.
    """
    by = [F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in dict.fromkeys([*order, *values])]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_first", first).where("_first = 1").select(*keys, *values)
