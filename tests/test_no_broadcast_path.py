"""Beyond the broadcast limit: every key restriction becomes a shuffled semi
join, and the results are identical to the broadcast plan."""

from shiftscore.config import ScoringConfig
from shiftscore.operators.joins import KeySet
from shiftscore.plans.pipelines import LeadJob
from shiftscore.sources.fixtures import bind_call_leads, bind_open_leads, bind_warehouse

from conftest import SF001

AS_OF = "2024-06-01 00:00:00"


def rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


def test_shuffled_restrictions_give_the_same_results(spark):
    wh = bind_warehouse(spark, SF001)
    expected = {}
    for variant, bind in (("open", bind_open_leads), ("call", bind_call_leads)):
        job = LeadJob.build(wh, bind(spark, SF001), variant, AS_OF)
        expected[variant] = (rows(job.active()), rows(job.remaining()))
        job.release()

    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        tiny = ScoringConfig(broadcast_key_limit=1, key_filter_slots=0)
        for variant, bind in (("open", bind_open_leads), ("call", bind_call_leads)):
            job = LeadJob.build(wh, bind(spark, SF001), variant, AS_OF, tiny)
            assert not job.scope.phones.small and not job.scope.customer_ids.small
            active, remaining = job.active(), job.remaining()
            assert (rows(active), rows(remaining)) == expected[variant]
            for df in (active, remaining):
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert "BroadcastExchange" not in plan and "BroadcastHashJoin" not in plan
            job.release()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_only_a_filter_of_fixed_size_is_broadcast_beyond_the_limit(spark):
    """Big relations are cut to about the lead rows before they are shuffled, and the results are the same."""
    wh, raw = bind_warehouse(spark, SF001), bind_open_leads(spark, SF001).where("mobile % 5 = 0")
    with LeadJob.build(wh, raw, "open", AS_OF) as job:
        expected = rows(job.active())
    with LeadJob.build(wh, raw, "open", AS_OF, ScoringConfig(broadcast_key_limit=0)) as job:
        ids = job.scope.customer_ids
        assert not ids.small and 0 < ids.filter().count() <= ids.frame.count()
        for relation in (wh.orders, wh.completed_spot_orders_mv, wh.demand_inventory_logging_v2, wh.customer_app_events):
            passed, exact = ids.prefilter(relation, "customer_id"), ids.restrict(relation, "customer_id")
            plan = passed._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning(customer_id" not in plan and "BroadcastHashJoin" in plan
            assert exact.count() <= passed.count() <= 1.05 * exact.count() < 0.5 * relation.count()
        assert rows(job.active()) == expected


def test_a_crowded_filter_only_lets_more_rows_pass(spark):
    rows_of = spark.range(1000).selectExpr("id AS customer_id", "id % 7 AS v").union(spark.createDataFrame([(None, 1)], "customer_id long, v long"))
    for slots in (64, 1000, 1 << 20):
        ks = KeySet(spark.range(0, 1000, 10), "id", False, slots)
        assert sorted(r.customer_id for r in ks.restrict(rows_of, "customer_id").collect()) == list(range(0, 1000, 10))
        ks.release()
    assert KeySet(spark.range(0), "id", False, 1000).restrict(rows_of, "customer_id").count() == 0
