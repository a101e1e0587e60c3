"""Small pieces that several operators share."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftscore.session import checkpoint_dir, scratch_path

#: A word: a run of code points other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def set_apart(docs: DataFrame, needed: tuple[str, ...]) -> DataFrame:
    """``docs`` with all columns but the needed ones renamed, so that no name of an operator's own can clash.

    ``df.select(*set_apart(docs, ...).columns).toDF(*docs.columns)`` undoes it.
    """
    return docs.toDF(*[c if c in needed else f"_x{k}" for k, c in enumerate(docs.columns)])


def text_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python in batches of at most ``rows``, so that long ones don't pile up in a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def n_words(text: Column) -> Column:
    """Number of words of a text; NULL counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def keep(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder.

    An executor that is lost later costs nothing before this point.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Like ``keep``, for larger tables: columnar and compressed, in the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Remembered(dict):
    """Values made once for each key; ``rotate`` bounds the size, and entries in use move over to the new lot."""

    def __init__(self, make: Callable):
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def rotate(self, limit: int) -> None:
        if len(self) > limit:
            self.old = dict(self)
            self.clear()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slots_for(rows: int, spark: SparkSession, rows_per_slot: int = 20_000) -> int:
    """How many slots a two-level running sum needs: it grows with the rows, so no slot does."""
    return max(8, 4 * shuffle_partitions(spark), math.ceil(rows / rows_per_slot))


def running_sum(df: DataFrame, group: list[str], slot: str, order: list, value: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows up to this one, in its group.

    Rows are ordered by ``slot``, then by ``order``.  Only totals per (group,
    slot) are summed over a whole group; the rows are summed within one slot.
    A group with a third of all rows is so spread over all its slots.  ``df``
    is read twice and must give the same rows each time.
    """
    totals = df.groupBy(*group, slot).agg(F.sum(value).alias("_slot_sum"))
    before = Window.partitionBy(*group).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1) if group else \
        Window.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(c).alias(f"_o_{c}") for c in [*group, slot]],
        F.coalesce(F.sum("_slot_sum").over(before), F.lit(0)).alias("_offset"))
    own = Window.partitionBy(*group, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn("_local", F.sum(value).over(own))
    on = [local[c].eqNullSafe(offsets[f"_o_{c}"]) for c in [*group, slot]]
    joined = local.join(offsets, on)
    return joined.select(*df.columns, (F.col("_local") + F.col("_offset")).alias(name))
