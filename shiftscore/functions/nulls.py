"""Null rules of the two systems the job mixes.

R's ``ifelse(test, yes, no)`` yields NA where ``test`` is NA, while SQL
``CASE WHEN`` sends a NULL test to ELSE.  Spark's ``when`` behaves like SQL,
so R-side expressions go through :func:`r_ifelse`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r_ifelse(test: Column, yes, no) -> Column:
    """R ``ifelse``: NULL test -> NULL, true -> yes, false -> no."""
    return F.when(test.isNull(), F.lit(None)).when(test, yes).otherwise(no)

