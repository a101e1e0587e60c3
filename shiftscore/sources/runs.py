"""Runs of a job and the tables each of them wrote.

Tables are written to folders of their own for every attempt, and one row in
the run log makes an attempt's tables count, all at once.  Readers look into the
log first and then read only folders that it names:

    <root>/runs/                        the log: JSON, one row for each committed attempt
    <root>/<table>/attempt=<name>/      what one attempt wrote

So a run that fails on the way changes nothing for readers, tables of one run
are never seen with those of another, and a run that is repeated under its id,
whatever the date, takes the place of its earlier attempt, even if it has no
rows any more.  A reader that works while a run commits sees the run as it was
or as it is, since superseded folders stay for one more commit.

Log rows are appended by Spark's commit protocol, which makes a file visible
when it is whole.  Two attempts that commit at the same time get the same
version; the greater attempt name then counts, for all readers alike.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import delete_path, path_exists

LOG = "runs"
LOG_SCHEMA = "run_id string, version long, attempt string, run_time timestamp_ntz, tables array<string>, rows map<string,bigint>"


@dataclass(frozen=True)
class Run:
    """One committed attempt."""

    run_id: str
    version: int
    attempt: str
    run_time: object
    tables: tuple[str, ...]
    rows: dict[str, int]

    @property
    def order(self) -> tuple[int, str]:
        return self.version, self.attempt


class RunStore:
    """The tables under one folder, by runs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str, attempt: str) -> str:
        return f"{self.root}/{table}/attempt={attempt}"

    def log(self) -> list[Run]:
        """All committed attempts in order: one small row for each."""
        path = f"{self.root}/{LOG}"
        if not path_exists(self.spark, path):
            return []
        rows = self.spark.read.schema(LOG_SCHEMA).json(path).collect()
        return sorted((Run(r.run_id, r.version, r.attempt, r.run_time, tuple(r.tables), dict(r.rows or {})) for r in rows), key=lambda r: r.order)

    def runs(self, table: str | None = None) -> list[Run]:
        """The attempt that counts of every run, by order; of those that wrote ``table`` if it is given."""
        last = {r.run_id: r for r in self.log()}
        return sorted((r for r in last.values() if table is None or table in r.tables), key=lambda r: r.order)

    def current(self, table: str) -> Run | None:
        """The last committed run that wrote ``table``."""
        return max((r for r in self.log() if table in r.tables), key=lambda r: r.order, default=None)

    def write(self, run_id: str, tables: dict[str, Callable[[str], int | None]], run_time: str) -> Run:
        """Write ``tables`` (each a function of the folder that returns its number of rows) and commit them as one.

        ``run_time`` is a UTC time as text.  If a table fails, what this attempt wrote is removed and the error is raised.
        """
        attempt = uuid.uuid4().hex
        try:
            rows = {name: put(self.path(name, attempt)) for name, put in tables.items()}
            log = self.log()
            version = max((r.version for r in log), default=0) + 1
            row = self.spark.range(1).select(
                F.lit(run_id).alias("run_id"), F.lit(version).cast("long").alias("version"), F.lit(attempt).alias("attempt"),
                F.lit(run_time).cast("timestamp_ntz").alias("run_time"), F.array(*[F.lit(n) for n in tables]).alias("tables"),
                F.from_json(F.lit(json.dumps({n: k for n, k in rows.items() if k is not None})), "map<string,bigint>").alias("rows"))
            row.coalesce(1).write.mode("append").json(f"{self.root}/{LOG}")
        except BaseException:
            for name in tables:
                delete_path(self.spark, self.path(name, attempt))
            raise
        return next(r for r in self.log() if r.attempt == attempt)

    def read(self, table: str, runs: list[Run], reader, schema: StructType) -> DataFrame:
        """Rows of ``table`` of these runs, with ``run_id`` and ``run_time`` of each."""
        if not runs:
            return self.spark.createDataFrame([], schema).withColumns(
                {"run_id": F.lit(None).cast("string"), "run_time": F.lit(None).cast("timestamp_ntz")})
        names = self.spark.createDataFrame([(r.attempt, r.run_id, r.run_time) for r in runs], "_attempt string, run_id string, run_time timestamp_ntz")
        rows = reader(self.root + "/" + table, [self.path(table, r.attempt) for r in runs])
        return rows.join(names, rows["attempt"] == names["_attempt"]).drop("attempt", "_attempt")

    def drop_superseded(self, current_only: tuple[str, ...] = ()) -> None:
        """Remove folders that no reader looks for any more.

        These are the attempts of a run that were superseded before the last
        commit, and for the tables of which only the current run is read
        (``current_only``) all but the last two.  Folders that the log doesn't
        name, such as those of a run at work, stay.
        """
        log = self.log()
        counting = {r.attempt for r in self.runs()}
        for k, run in enumerate(log[:-2]):
            for table in run.tables:
                of_table = [r.attempt for r in log if table in r.tables]
                if run.attempt not in (of_table[-2:] if table in current_only else [*counting, *[r.attempt for r in log[-2:]]]):
                    delete_path(self.spark, self.path(table, run.attempt))
