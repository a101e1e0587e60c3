"""Sinks (O60, O61): current snapshot and history log.

Both go through a :class:`~.runs.RunStore`.  The snapshot (Parquet) is the table
of the last committed run: a run that fails leaves the one before it readable.
The history is a headerless CSV log with one entry for each run id: a run that
is repeated takes the place of its earlier attempt, on whatever day and also if
it has no rows.  NULLs are written as ``NA``, as the original does, so a text
that is really ``NA`` reads back as NULL.  Unlike the original, Spark quotes
every field (numbers and ``NA`` included).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from ..session import utc_now
from .runs import RunStore

HISTORY_OPTIONS = {"header": "false", "quoteAll": "true", "nullValue": "NA", "sep": ","}
#: Name of the table in a folder that holds nothing else.
TABLE = "data"


def rendered(df: DataFrame, days_as_text: bool) -> DataFrame:
    """Days as text, as the open variant writes them."""
    if days_as_text and "days_remaining" in df.columns:
        df = df.withColumn("days_remaining", F.col("days_remaining").cast("string"))
    return df


def snapshot_of(df: DataFrame, rows: int | None = None, fmt: str = "parquet") -> Callable[[str], int | None]:
    """A snapshot for ``RunStore.write``."""
    def put(path: str) -> int | None:
        df.write.format(fmt).save(path)
        return rows
    return put


def history_of(df: DataFrame, rows: int | None = None) -> Callable[[str], int | None]:
    """A history entry for ``RunStore.write``."""
    def put(path: str) -> int | None:
        df.write.options(**HISTORY_OPTIONS).csv(path)
        return rows
    return put


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", days_as_text: bool = False) -> None:
    """Make ``df`` the current table under ``path``.  ``days_as_text`` renders days as strings first."""
    store = RunStore(df.sparkSession, path)
    store.write("snapshot", {TABLE: snapshot_of(rendered(df, days_as_text), fmt=fmt)}, utc_now())
    store.drop_superseded((TABLE,))


def read_snapshot(spark: SparkSession, path: str, table: str = TABLE, fmt: str = "parquet") -> DataFrame:
    """The current table: that of the last run that was committed."""
    store = RunStore(spark, path)
    run = store.current(table)
    if run is None:
        raise ValueError(f"no run has written {table} under {path}")
    return spark.read.format(fmt).load(store.path(table, run.attempt))


def write_history(df: DataFrame, path: str, run_id: str, days_as_text: bool = False, run_time: str | None = None) -> None:
    """Put one run into the CSV history, in place of what the same run wrote before."""
    store = RunStore(df.sparkSession, path)
    store.write(run_id, {TABLE: history_of(rendered(df, days_as_text))}, run_time or utc_now())
    store.drop_superseded()


def read_history(spark: SparkSession, path: str, schema: StructType, table: str = TABLE) -> DataFrame:
    """All runs of the history with the table's schema (no inference), ``run_id`` and ``run_time``."""
    store = RunStore(spark, path)
    full = StructType([*schema.fields, StructField("attempt", StringType())])

    def reader(base: str, paths: list[str]) -> DataFrame:
        return spark.read.schema(full).options(**HISTORY_OPTIONS).option("basePath", base).csv(paths)

    return store.read(table, store.runs(table), reader, schema)
