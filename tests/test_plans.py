"""Plan shape: semi/anti joins where intended, no Python UDF, no Cartesian
product, filters pushed into the Parquet scan, customer-id partitioning kept."""

import pytest

from shiftscore.plans.registry import registry

from conftest import SF001


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    reg = registry()
    return {n: executed_plan(reg[n](spark, SF001))
            for n in ("active_leads_calls", "remaining_leads_open", "customer_score")}


def test_no_python_udf_or_cartesian(plans):
    for plan in plans.values():
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                    "BroadcastNestedLoopJoin"):
            assert bad not in plan


def test_semi_and_anti_joins(plans):
    assert "LeftSemi" in plans["customer_score"]
    assert "LeftAnti" in plans["remaining_leads_open"]


def test_filters_and_columns_reach_the_scan(spark):
    from shiftscore.sources.fixtures import bind_warehouse

    wh = bind_warehouse(spark, SF001)
    df = wh.sf_customer_signup_requests.select("mobile")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,signup)" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_status_filter_pushed_on_a_real_orders_table(spark, tmp_path):
    from shiftscore.operators import features as FT
    from shiftscore.plans.pipelines import LeadJob
    from shiftscore.sources.fixtures import bind_open_leads, bind_warehouse

    wh = bind_warehouse(spark, SF001)
    path = str(tmp_path / "orders")
    wh.orders.write.parquet(path)
    wh.orders = spark.read.parquet(path)
    job = LeadJob.build(wh, bind_open_leads(spark, SF001), "open", "2024-06-01 00:00:00")
    cod = FT.customer_orders(job.scope, FT.latest_install(job.scope))
    plan = executed_plan(cod)
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,4)" in plan
    assert "ReadSchema: struct<order_id:bigint,customer_id:bigint,pickup_time:bigint,status:int>" in plan
    job.release()


def test_p1_scans_the_inventory_log_once(spark, tmp_path):
    from shiftscore.plans.pipelines import LeadJob
    from shiftscore.sources.fixtures import bind_open_leads, bind_warehouse

    wh = bind_warehouse(spark, SF001)
    path = str(tmp_path / "inventory-log")
    wh.demand_inventory_logging_v2.write.parquet(path)
    wh.demand_inventory_logging_v2 = spark.read.parquet(path)
    with LeadJob.build(wh, bind_open_leads(spark, SF001), "open", "2024-06-01 00:00:00") as job:
        p1 = job.customer_score()
        cached = str(p1._jdf.queryExecution().optimizedPlan())
        full = str(p1._jdf.queryExecution().withCachedData())
        assert "inventory-log" not in cached and cached.count("InMemoryRelation") >= 2
        assert "drop_location" in full
