"""Operators on literal rows: top-1 semantics, fan-out counts, keys, skew."""

import datetime as dt

import pandas as pd

from pyspark.sql import functions as F

from shiftscore.operators.features import LeadScope, app_summary, latest_install
from shiftscore.operators.joins import KeySet, proven_small
from shiftscore.operators.leads import lead_frequency, unscored_leads, uncalled
from shiftscore.operators.ranking import rank_by_score, with_position
from shiftscore.operators.topk import first_per_group
from shiftscore.sources.warehouse import RELATIONS, Warehouse


def test_first_per_group_null_date_wins_descending(spark):
    df = spark.createDataFrame(
        [("a", "app", dt.date(2024, 1, 2), 0), ("a", "app", None, 0), ("a", "app", dt.date(2024, 1, 5), 1),
         ("b", None, dt.date(2024, 1, 1), 0), ("b", None, dt.date(2024, 1, 1), 1)],
        "m string, s string, d date, attr int")
    out = first_per_group(df, ["m", "s"], ["d", "attr"], ["d", "attr"], descending=True)
    got = {(r.m, r.s): (r.d, r.attr) for r in out.collect()}
    assert got == {("a", "app"): (None, 0), ("b", None): (dt.date(2024, 1, 1), 1)}


def test_first_per_group_ascending_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 9), (1, 50, 7), (1, 50, 3), (2, None, 4)],
                               "c int, t long, o long")
    out = first_per_group(df, ["c"], ["t", "o"], ["o"], descending=False)
    assert {r.c: r.o for r in out.collect()} == {1: 3, 2: 4}


def test_first_per_group_matches_pandas_on_a_hot_key(spark):
    # One key holds a third of all rows.
    rows = [(0 if i % 3 == 0 else i % 50, (i * 7919) % 1000, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k int, t int, id int").repartition(7)
    out = first_per_group(df, ["k"], ["t", "id"], ["id"], descending=True).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "t", "id"]).sort_values(["k", "t", "id"], ascending=False)
    want = pdf.groupby("k").head(1).set_index("k")["id"].to_dict()
    assert out.set_index("k")["id"].to_dict() == want


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_restrict_empty_key_set(spark):
    df = spark.createDataFrame([(1,), (2,)], "x long")
    keys = spark.createDataFrame([], "key long")
    assert proven_small(keys, 0)
    assert KeySet(keys, "key", True).restrict(df, "x").count() == 0
    assert KeySet(keys, "key").restrict(df, "x").count() == 0


def test_restrict_broadcasts_only_proven_keys(spark):
    # With Spark's own size-based broadcast off, unproven keys are joined by shuffle.
    df = spark.range(100).withColumnRenamed("id", "x")
    keys = spark.range(0, 100, 2).withColumnRenamed("id", "key")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = KeySet(keys, "key", proven_small(keys, 10)).restrict(df, "x")
        assert out.count() == 50
        assert "BroadcastExchange" not in executed(out)
        assert "BroadcastExchange" in executed(KeySet(keys, "key", proven_small(keys, 1000)).restrict(df, "x"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_proof_moves_no_rows(spark):
    """The count that decides a broadcast sends one number per partition to the last task."""
    plan = spark.range(1000).repartition(4).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "LocalLimit" not in plan


def test_position_follows_the_order(spark):
    rows = [(i, "abc"[i % 3], None if i % 7 == 0 else (i * 37) % 11) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, name string, weighted_score int").repartition(7)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = with_position(df)
        assert got.select(F.spark_partition_id()).distinct().count() > 1
        found = {r.id: r.position for r in got.collect()}
        ordered = [r.id for r in rank_by_score(df).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    want = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0], r[1]))
    assert [r[0] for r in want] == ordered
    assert found == {r[0]: k + 1 for k, r in enumerate(want)}


def test_app_list_repeats_names_without_rows(spark):
    rows = spark.createDataFrame([(1, "Uber", "daily convenience")] * 3 + [(1, "CRED", "luxury"), (2, "Uber", "daily convenience")],
                                 "customer_id long, application_name string, app_type string")
    out = app_summary(None, rows)
    got = {r.customer_id: (r.app_installed, r.daily_convenience_apps_installed) for r in out.collect()}
    assert got == {1: ("{CRED,Uber,Uber,Uber}", 3), 2: ("{Uber}", 1)}
    plan = executed(out)
    assert "flatten" not in plan and "array_repeat" not in plan


def test_many_signups_and_spots_of_one_phone(spark):
    """10 000 sign-ups and 10 000 spots of a phone are reduced before they meet."""
    n = 10_000
    empty = spark.createDataFrame([], "x int")
    spots = spark.range(n)
    wh = Warehouse(**{name: empty for name in RELATIONS} | {
        "customers": spark.createDataFrame([(1, "9", 1)], "id long, mobile string, geo_region_id int"),
        "sf_customer_signup_requests": spots.select(
            F.lit("9").alias("mobile"), F.lit("app").alias("source"),
            (F.lit("2024-01-01").cast("timestamp_ntz") + F.expr("make_interval(0, 0, 0, cast(id % 50 as int))")).alias("request_ts")),
        "sf_lead_spot_detail_phones": spots.select(F.lit("9").alias("number"), F.col("id").alias("detail_id")),
        "sf_lead_spot_details": spots.select("id", F.col("id").alias("lead_spot_id"), F.format_string("r%05d", F.col("id")).alias("geo_region_curated")),
        "sf_lead_spot_registration_attributions": spots.select(
            F.col("id").alias("lead_id"), F.when(F.col("id") < 100, "attribution_paid").otherwise("organic").alias("attribution"))})
    scope = LeadScope.build(wh, spark.createDataFrame([(9,)], "mobile long"))
    rows = latest_install(scope).collect()
    scope.release()
    assert [tuple(r) for r in rows] == [("9", "app", dt.date(2024, 2, 19), "r00099", 1)]


def test_uncalled_drops_null_status(spark):
    df = spark.createDataFrame([("Call not done",), ("",), (None,), ("2024-01-01",)], "calling_status string")
    assert sorted(r[0] for r in uncalled(df).collect()) == ["", "Call not done"]


def test_lead_frequency_null_phone_is_a_group(spark):
    df = spark.createDataFrame(
        [(1, "app"), (1, "app"), (1, None), (None, "x"), (None, "y"), (2, None)],
        "mobile long, source string")
    out = {(r.mobile, r.source): (r.count_source, r.count_mobile_number)
           for r in lead_frequency(df).collect()}
    assert out[(1, "app")] == (2, 3) and out[(1, None)] == (2, 3)
    assert out[(None, "x")] == (2, 2)
    assert out[(2, None)] == (1, 1)


def test_unscored_keeps_null_phone_and_dedups(spark):
    leads = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "mobile long, source string")
    found = spark.createDataFrame([(1,)], "key long")
    out = sorted((r.mobile or -1, r.source) for r in unscored_leads(leads, found).collect())
    assert out == [(-1, "c"), (2, "b")]
