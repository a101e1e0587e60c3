"""The batch job: same tables as the lazy pipeline, one history per run id, all sheets of a folder as one list."""

import os

import pytest
from pyspark.sql import functions as F

import shiftscore.__main__ as cli
from shiftscore.plans.job import run_scoring_job
from shiftscore.plans.pipelines import LeadJob
from shiftscore.session import checkpoint_dir, scratch_path
from shiftscore.sources.fixtures import bind_open_leads, bind_warehouse
from shiftscore.sources.leads import OPEN_LEAD_HEADERS, read_open_leads, sheet_frame
from shiftscore.sources.sinks import read_history, read_snapshot
from shiftscore.sources.warehouse import RELATIONS, load_warehouse

from conftest import SF001

AS_OF = "2024-06-01 00:00:00"


def rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


def text_days(df):
    return df.withColumn("days_remaining", F.col("days_remaining").cast("string"))


def test_job_writes_the_pipeline_and_repeats_safely(spark):
    wh, raw = bind_warehouse(spark, SF001), bind_open_leads(spark, SF001)
    out = scratch_path(spark, "job-out")
    before = set(os.listdir(checkpoint_dir(spark).replace("file:", "")))
    for _ in range(2):
        res = run_scoring_job(wh, raw, "open", out, AS_OF, run_id="r1")
    assert not [d for d in set(os.listdir(checkpoint_dir(spark).replace("file:", ""))) - before if d.startswith("features")]
    with LeadJob.build(wh, raw, "open", AS_OF) as expected:
        want = text_days(expected.active())
        assert dict(want.dtypes)["days_remaining"] == "string"
        assert rows(read_snapshot(spark, out, "active")) == rows(want)
        assert rows(read_snapshot(spark, out, "remaining")) == rows(text_days(expected.remaining()))
        history = read_history(spark, out, want.schema, "active_history")
        assert res.active_rows == history.count() == want.count()
    run_scoring_job(wh, raw, "open", out, AS_OF, run_id="r2")
    assert history.count() == res.active_rows  # a reader stays with the runs that it has found
    assert read_history(spark, out, want.schema, "active_history").count() == 2 * res.active_rows


def test_two_sheets_are_one_list(spark, tmp_path):
    wh, raw = bind_warehouse(spark, SF001), bind_open_leads(spark, SF001)
    sheet = sheet_frame(raw, OPEN_LEAD_HEADERS)
    folder = str(tmp_path / "sheets")
    for part in (0, 1):
        (sheet.where(F.col("Mobile") % 2 == part).coalesce(1).write.mode("append")
         .option("header", True).option("nullValue", "NA").csv(folder))
    both = read_open_leads(spark, folder, null_value="NA")
    with LeadJob.build(wh, raw, "open", AS_OF) as one, LeadJob.build(wh, both, "open", AS_OF) as two:
        assert rows(one.active()) == rows(two.active())


def test_command_line_over_a_warehouse_folder(spark, tmp_path, monkeypatch, capsys):
    bound = bind_warehouse(spark, SF001).as_dict()
    for name in RELATIONS:
        bound[name].write.parquet(str(tmp_path / "wh" / name))
    bind_open_leads(spark, SF001).write.parquet(str(tmp_path / "leads"))
    assert load_warehouse(spark, str(tmp_path / "wh")).orders.count() == bound["orders"].count()
    with pytest.raises(ValueError):
        load_warehouse(spark)
    monkeypatch.setattr(cli, "get_session", lambda: spark)
    cli.main(["--warehouse", str(tmp_path / "wh"), "--leads", str(tmp_path / "leads"), "--leads-format", "parquet",
              "--variant", "open", "--out", str(tmp_path / "out"), "--as-of", AS_OF])
    with LeadJob.build(bind_warehouse(spark, SF001), bind_open_leads(spark, SF001), "open", AS_OF) as job:
        assert f"active={job.active().count()} " in capsys.readouterr().out


def test_command_line_reports_and_stores_malformed_rows(spark, tmp_path, monkeypatch, capsys):
    bound = bind_warehouse(spark, SF001).as_dict()
    for name in RELATIONS:
        bound[name].write.parquet(str(tmp_path / "wh" / name))
    sheets = tmp_path / "sheets"
    sheets.mkdir()
    head = ",".join(OPEN_LEAD_HEADERS)
    (sheets / "a.csv").write_text(f"{head}\n9000000001,app,Tower,Lake,2024-01-07,2024-01-05,3\n9000000002,app\n")
    (sheets / "b.csv").write_text(f"Remark,{head}\nx,8000000001,app,Tower,Lake,2024-01-07,2024-01-05,3\ny,8000000002,app,T,L,2024-01-07,2024-01-05,3,4,5\n")
    monkeypatch.setattr(cli, "get_session", lambda: spark)
    args = ["--warehouse", str(tmp_path / "wh"), "--leads", str(sheets), "--variant", "open", "--out", str(tmp_path / "out")]
    cli.main([*args, "--run-id", "kept"])
    assert "remaining=2 malformed=2" in capsys.readouterr().out
    cli.main([*args, "--run-id", "apart", "--set-aside"])
    assert "remaining=1 malformed=2" in capsys.readouterr().out
    bad = {r.file.rsplit("/", 1)[1]: r.record for r in read_snapshot(spark, str(tmp_path / "out"), "quarantine").collect()}
    assert bad["a.csv"] == "9000000002,app" and bad["b.csv"].startswith("y,8000000002") and len(bad) == 2


def test_one_time_in_a_run_without_as_of(spark):
    wh, raw, out = bind_warehouse(spark, SF001), bind_open_leads(spark, SF001), scratch_path(spark, "job-time")
    run_scoring_job(wh, raw, "open", out, run_id="r")
    times = {t for name in ("active", "remaining") for (t,) in read_snapshot(spark, out, name).select("created_at").distinct().collect()}
    assert len(times) == 1


def test_checkpoint_folder_must_be_shared_off_a_local_master():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_few_jobs_before_the_first_action(spark):
    """Planning P1 counts the lead rows and the lead customers, no more."""
    sc = spark.sparkContext
    wh, raw = bind_warehouse(spark, SF001), bind_open_leads(spark, SF001)  # opening files is a job for each
    sc.setJobGroup("plan", "plan")
    with LeadJob.build(wh, raw, "open", AS_OF) as job:
        df = job.customer_score()
        planned = len(sc.statusTracker().getJobIdsForGroup("plan"))
        sc.setJobGroup("run", "run")
        df.write.format("noop").mode("overwrite").save()
        ran = len(sc.statusTracker().getJobIdsForGroup("run"))
        sc.setJobGroup("other", "other")
    print("jobs", planned, ran)
    assert planned <= 11 and planned + ran <= 45
