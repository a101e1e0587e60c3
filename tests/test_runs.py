"""The run log: what readers see while, before and after runs commit, fail and repeat."""

import os

import pytest
from pyspark.sql import functions as F

from shiftscore.plans import job as job_module
from shiftscore.plans.job import run_scoring_job
from shiftscore.session import scratch_path
from shiftscore.sources.fixtures import bind_open_leads, bind_warehouse
from shiftscore.sources.runs import RunStore
from shiftscore.sources.sinks import history_of, read_history, read_snapshot, snapshot_of, write_history, write_snapshot

from conftest import SF001

AS_OF = "2024-06-01 23:59:00"


def frame(spark, *values):
    return spark.createDataFrame([(v, f"t{v}") for v in values], "k long, name string")


def keys(df):
    return sorted(r.k for r in df.collect())


def test_a_run_repeated_past_midnight_is_there_once(spark):
    path = scratch_path(spark, "hist")
    write_history(frame(spark, 1, 2, 3), path, "r", run_time="2024-06-01 23:59:59")
    write_history(frame(spark, 4), path, "other", run_time="2024-06-01 23:59:59")
    write_history(frame(spark, 1, 2, 3), path, "r", run_time="2024-06-02 00:00:01")
    back = read_history(spark, path, frame(spark).schema)
    assert keys(back) == [1, 2, 3, 4]
    assert {(r.run_id, str(r.run_time)) for r in back.collect()} == {("r", "2024-06-02 00:00:01"), ("other", "2024-06-01 23:59:59")}


def test_a_run_repeated_without_rows_has_none(spark):
    path = scratch_path(spark, "hist")
    write_history(frame(spark, 1, 2, 3), path, "r")
    write_history(frame(spark, 4), path, "other")
    write_history(frame(spark), path, "r")
    assert keys(read_history(spark, path, frame(spark).schema)) == [4]


def test_a_reader_sees_the_old_or_the_new_run(spark):
    path = scratch_path(spark, "hist")
    schema = frame(spark).schema
    assert read_history(spark, path, schema).count() == 0
    write_history(frame(spark, 1, 2), path, "r")
    before = read_history(spark, path, schema)
    store = RunStore(spark, path)
    seen = []

    def slow(folder):
        rows = history_of(frame(spark, 7, 8))(folder)
        seen.append(keys(read_history(spark, path, schema)))      # written, not committed
        return rows

    store.write("r", {"data": slow}, AS_OF)
    assert seen == [[1, 2]] and keys(read_history(spark, path, schema)) == [7, 8]
    assert keys(before) == [1, 2]                                   # a reader from before is still served
    write_history(frame(spark, 9), path, "r")
    write_history(frame(spark, 9), path, "r")
    assert len([d for d in os.listdir(f"{path}/data".replace("file:", "")) if d.startswith("attempt")]) == 2


def test_a_failed_write_leaves_the_snapshot(spark):
    path = scratch_path(spark, "snap")
    write_snapshot(frame(spark, 1, 2), path)
    broken = frame(spark, 3).withColumn("k", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        write_snapshot(broken, path)
    assert keys(read_snapshot(spark, path)) == [1, 2]
    assert len([d for d in os.listdir(f"{path}/data".replace("file:", "")) if d.startswith("attempt")]) == 1
    with pytest.raises(ValueError, match="no run"):
        read_snapshot(spark, scratch_path(spark, "nothing"))


def test_tables_of_one_run_come_together(spark):
    path = scratch_path(spark, "two")
    store = RunStore(spark, path)
    for k in (1, 2, 3, 4):
        store.write(f"r{k}", {n: snapshot_of(frame(spark, k), 1) for n in ("active", "remaining")}, AS_OF)
        store.drop_superseded(("active", "remaining"))

    def failing(folder):
        raise RuntimeError("remaining")

    with pytest.raises(RuntimeError):
        store.write("r5", {"active": snapshot_of(frame(spark, 5)), "remaining": failing}, AS_OF)
    assert [keys(read_snapshot(spark, path, n)) for n in ("active", "remaining")] == [[4], [4]]
    assert len(os.listdir(f"{path}/active".replace("file:", ""))) == 2
    assert [r.run_id for r in store.runs("active")] == ["r1", "r2", "r3", "r4"] and store.current("active").rows == {"active": 1, "remaining": 1}


def test_a_job_that_fails_midway_changes_nothing(spark, monkeypatch):
    wh, raw, out = bind_warehouse(spark, SF001), bind_open_leads(spark, SF001), scratch_path(spark, "job")
    first = run_scoring_job(wh, raw, "open", out, AS_OF, run_id="r1")
    schema = read_snapshot(spark, out, "remaining").schema

    def fail(*args):
        def put(folder):
            raise RuntimeError("disk")
        return put

    monkeypatch.setattr(job_module, "history_of", fail)
    with pytest.raises(RuntimeError, match="disk"):
        run_scoring_job(wh, raw.limit(10), "open", out, AS_OF, run_id="r2")
    monkeypatch.undo()
    assert read_snapshot(spark, out, "active").count() == first.active_rows
    assert read_history(spark, out, schema, "remaining_history").count() == first.remaining_rows
    # The same run again, past midnight and on a shorter list, replaces itself in all four tables.
    again = run_scoring_job(wh, raw.where("mobile is null"), "open", out, "2024-06-02 00:01:00", run_id="r1")
    assert again.active_rows == 0 < again.remaining_rows < first.remaining_rows
    assert read_history(spark, out, schema, "remaining_history").count() == again.remaining_rows == read_snapshot(spark, out, "remaining").count()
    assert read_history(spark, out, schema, "active_history").count() == 0 == read_snapshot(spark, out, "active").count()
