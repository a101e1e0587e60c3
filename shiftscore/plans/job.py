"""The scoring run as a batch job: leads in, four tables out.

One run takes one time (``as_of``, or the moment it starts), computes the
customer feature table once and writes it to the shared scratch folder, so a
lost executor costs a re-read, not a re-run of the warehouse joins; the folder
is removed when the run ends.  It then writes, as one commit of the run log
under ``out`` (see :mod:`shiftscore.sources.runs`):

* ``active``, ``remaining``                   the current scores (Parquet)
* ``active_history``, ``remaining_history``   headerless CSV, one entry for each run id
* ``quarantine``                              rows of the sheet with a wrong number of cells: file and raw record

Until the commit, and if any of them fails, readers see the run before.  A run
that is repeated under the same ``run_id`` replaces itself.  The open variant
renders days as text in all four, as the original does.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..config import DEFAULT, ScoringConfig
from ..session import delete_path, scratch_path, utc_now
from ..sources.runs import RunStore
from ..sources.sinks import history_of, rendered, snapshot_of
from ..sources.warehouse import Warehouse
from .pipelines import LeadJob

SNAPSHOTS = ("active", "remaining")


@dataclass
class RunResult:
    active_rows: int
    remaining_rows: int
    malformed_rows: int = 0
    attempt: str = ""


def run_scoring_job(wh: Warehouse, raw_leads: DataFrame, variant: str, out_dir: str,
                    as_of: str | None = None, cfg: ScoringConfig = DEFAULT,
                    history: bool = True, run_id: str | None = None, malformed: DataFrame | None = None) -> RunResult:
    """``run_id`` names the run in the log (a new one is made if it is not given); ``malformed`` goes to the quarantine."""
    spark = raw_leads.sparkSession
    as_of, run_id = as_of or utc_now(), run_id or uuid.uuid4().hex
    scratch = scratch_path(spark, "features")
    store, text, held = RunStore(spark, out_dir), variant == "open", []
    with LeadJob.build(wh, raw_leads, variant, as_of, cfg) as job:
        try:
            job.customer_score().write.parquet(scratch)
            tables = {"active": job.active(spark.read.parquet(scratch)), "remaining": job.remaining()}
            counts, writes = {}, {}
            for name, table in tables.items():
                table = rendered(table, text).persist()
                held.append(table)
                counts[name] = table.count()
                writes[name] = snapshot_of(table, counts[name])
                if history:
                    writes[f"{name}_history"] = history_of(table, counts[name])
            if malformed is not None:
                # Read once for both: the sheet is small, its bad rows fewer.
                bad = malformed.persist()
                held.append(bad)
                counts["quarantine"] = bad.count()
                writes["quarantine"] = snapshot_of(bad, counts["quarantine"])
            run = store.write(run_id, writes, as_of)
            store.drop_superseded(SNAPSHOTS)
            return RunResult(counts["active"], counts["remaining"], counts.get("quarantine", 0), run.attempt)
        finally:
            for table in held:
                table.unpersist()
            delete_path(spark, scratch)
