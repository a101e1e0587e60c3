"""Registered queries: one per operator of the blueprint, over the test tables.

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables (through the binding in :mod:`shiftscore.sources.fixtures`).
The matching DuckDB SQL is in :mod:`shiftscore.oracle.queries`; column names
agree one to one.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..functions.keywords import address_match
from ..functions.weights import source_weight, urgency_weight, interest_weight
from ..operators import features as FT
from ..operators.leads import (days_remaining, lead_frequency, lead_keys, prepare_call_leads,
                               prepare_open_leads, uncalled)
from ..operators.ranking import with_position
from ..session import scratch_path
from ..sources.fixtures import bind_call_leads, bind_open_leads, bind_warehouse
from ..sources.leads import (OPEN_LEAD_HEADERS, normalize_columns,
                             read_call_leads, read_open_leads, sheet_frame)
from ..sources.sinks import read_history, read_snapshot, write_history, write_snapshot
from .pipelines import LeadJob, lead_match, repeat_weight, score_active, score_remaining

AS_OF = "2024-06-01 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf: str, variant: str) -> DataFrame:
    return (bind_open_leads if variant == "open" else bind_call_leads)(spark, sf)


_OPEN_JOBS: list[LeadJob] = []


def release_previous() -> None:
    """Drop the cached intermediates of earlier registered queries.

    Registered queries return lazy DataFrames whose plans read cached
    intermediates; a caller running them one after another releases the
    previous ones before building the next (an earlier DataFrame still works
    afterwards, it just recomputes).
    """
    while _OPEN_JOBS:
        _OPEN_JOBS.pop().release()


def _job(spark: SparkSession, sf: str, variant: str = "open") -> LeadJob:
    job = LeadJob.build(bind_warehouse(spark, sf), _raw(spark, sf, variant), variant, AS_OF)
    _OPEN_JOBS.append(job)
    return job


def _p1(spark, sf, variant="open"):
    job = _job(spark, sf, variant)
    return job, FT.customer_score(job.scope, AS_OF)


def _orders(spark, sf):
    """The lead scope and its order summary, which several operators start from."""
    scope = _job(spark, sf).scope
    return scope, scope.keep(FT.customer_orders(scope, FT.latest_install(scope)))


# --- sources ----------------------------------------------------------------

def q_read_open_leads(spark, sf):
    path = scratch_path(spark, "open-leads-sheet")
    sheet = sheet_frame(_raw(spark, sf, "open"), OPEN_LEAD_HEADERS)
    dotted = sheet.toDF(*[re.sub(r"[^0-9A-Za-z]", ".", c) for c in sheet.columns]).withColumn(
        "Remarks", F.lit('said "yes",\nthen left'))
    dotted.write.options(header=True, nullValue="NA", escape='"').csv(path)
    return read_open_leads(spark, path, null_value="NA")


def call_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The call-sheet export: 16 text columns, phone numbers written as doubles."""
    from ..sources import fixtures as FX

    none = F.lit(None).cast("string")
    return FX.bind_call_leads(spark, sf).select(
        none.alias("Lead Id"), F.col("source").alias("Source"), F.col("lead_ts").cast("string").alias("Timestamp"),
        none.alias("Name"), F.col("mobile").cast("double").cast("string").alias("Mobile Number"),
        F.col("pickup_address").alias("Pickup address"), F.col("drop_address").alias("Drop_address"),
        F.col("shifting_date").cast("string").alias("Tentative Shifting Date"),
        F.col("calling_status").alias("Calling Timestamp"),
        F.col("wa_shifting_date").alias("WA_Tentative Shifting Date"),
        # Cells that the readers must not trip over.
        F.lit('said "yes", twice').alias("Owner"), F.lit("first line\nsecond line").alias("City"),
        none.alias("Remarks"), none.alias("Follow up"), none.alias("Agent"), none.alias("Sheet Row"))


def q_read_call_leads(spark, sf):
    path = scratch_path(spark, "call-leads-sheet")
    # Exported with an explicit NA marker, so empty statuses stay "" and
    # missing ones NULL (the uncalled filter tells them apart).
    call_sheet(spark, sf).write.options(header=True, nullValue="NA", escape='"').csv(path)
    return read_call_leads(spark, path, null_value="NA")


def q_normalize_columns(spark, sf):
    sheet = sheet_frame(_raw(spark, sf, "open"), OPEN_LEAD_HEADERS)
    return normalize_columns(sheet, OPEN_LEAD_HEADERS)


def q_restrict_to_keys(spark, sf):
    job = _job(spark, sf, "open")
    signups = job.scope.wh.sf_customer_signup_requests.select("mobile", "source", "request_ts")
    return job.scope.phones.restrict(signups, "mobile")


# --- lead side ----------------------------------------------------------------

def q_uncalled_leads(spark, sf):
    return uncalled(_raw(spark, sf, "call"))


def q_days_remaining(spark, sf):
    return days_remaining(_raw(spark, sf, "open"), "created_date").select(
        "mobile", "source", "created_date", "shifting_date", "days_remaining")


def q_days_remaining_override(spark, sf):
    return prepare_call_leads(_raw(spark, sf, "call"))


def q_lead_columns(spark, sf):
    return prepare_open_leads(_raw(spark, sf, "open"))


def q_lead_keys(spark, sf):
    return lead_keys(prepare_open_leads(_raw(spark, sf, "open")))


def q_address_keyword(spark, sf):
    orders = bind_warehouse(spark, sf).completed_spot_orders_mv
    hit = address_match(["to_address", "from_address"], C.ORDER_ADDRESS_KEYWORDS)
    return orders.select(
        "order_id", "customer_id", "to_address", "from_address",
        F.when(hit, F.lit(C.KEYWORD_TRIP)).otherwise(F.lit(C.OTHER_TRIP)).alias("trip_keyword_flag"))


def q_lead_address_keyword(spark, sf):
    leads = prepare_open_leads(_raw(spark, sf, "open"))
    return leads.select("mobile", "pickup_address", "drop_address", lead_match().alias("address_match"))


# --- customer features -------------------------------------------------------

def q_lead_customers(spark, sf):
    return FT.lead_customers(_job(spark, sf).scope)


def q_install_attribution(spark, sf):
    return FT.install_attribution(_job(spark, sf).scope)


def q_latest_install(spark, sf):
    return FT.latest_install(_job(spark, sf).scope)


def q_customer_installs(spark, sf):
    s = _job(spark, sf).scope
    return FT.customer_installs(s, FT.latest_install(s))


def q_customer_orders(spark, sf):
    return _orders(spark, sf)[1]


def q_last_order_keyword(spark, sf):
    return FT.last_order_keyword(*_orders(spark, sf))


def q_customer_keys(spark, sf):
    return FT.customer_keys(_orders(spark, sf)[1])


def q_helper_attempts(spark, sf):
    return FT.helper_attempts(*_orders(spark, sf))


def q_latest_vehicle(spark, sf):
    return FT.latest_vehicle(_job(spark, sf).scope)


def q_app_category(spark, sf):
    return FT.app_category_rows(_job(spark, sf).scope)


def q_app_totals(spark, sf):
    return FT.app_summary(_job(spark, sf).scope).select("customer_id", *FT.APP_COUNT_NAMES)


def q_app_list(spark, sf):
    return FT.app_summary(_job(spark, sf).scope).select("customer_id", "app_installed")


def q_latest_device(spark, sf):
    return FT.latest_device(_job(spark, sf).scope)


def q_device_flag(spark, sf):
    return FT.device_signature(_job(spark, sf).scope)


def q_customer_features(spark, sf):
    return FT.customer_features(_job(spark, sf).scope)


FLAG_COLUMNS = ["luxury_apps_flag", "competitor_apps_flag", "daily_convenience_apps_flag",
                "ecommerce_apps_flag", "house_shifting_apps_flag", "helper_flag", "lto_0_flag",
                "trip_flag"]


def q_feature_flags(spark, sf):
    return _p1(spark, sf)[1].select("customer_id", "mobile", *FLAG_COLUMNS)


def q_base_score(spark, sf):
    return _p1(spark, sf)[1].select("customer_id", "mobile", "weighted_score")


def q_customer_score(spark, sf):
    return _p1(spark, sf)[1]


# --- scoring ------------------------------------------------------------------

def _scored(spark, sf, variant="open"):
    job, p1 = _p1(spark, sf, variant)
    return job, job.scored(p1)


def q_scored_leads_join(spark, sf):
    return _scored(spark, sf)[1]


def q_source_weight(spark, sf):
    leads = prepare_open_leads(_raw(spark, sf, "open"))
    return leads.select("mobile", "source", source_weight(F.col("source")).alias("source_weight"))


def q_society_flag(spark, sf):
    scored = score_active(_scored(spark, sf)[1], "open")
    return scored.select("mobile", "customer_id", "pickup_address", "drop_address", "trip_flag",
                         "society_flag")


def q_urgency_weight(spark, sf):
    leads = prepare_open_leads(_raw(spark, sf, "open"))
    return leads.select("mobile", "days_remaining",
                        urgency_weight(F.col("days_remaining")).alias("urgency_weight"))


def q_interest_weight(spark, sf):
    leads = prepare_open_leads(_raw(spark, sf, "open"))
    return leads.select("mobile", "order_interests",
                        interest_weight(F.col("order_interests")).alias("interest_weight"))


def q_lead_frequency(spark, sf):
    job, scored = _scored(spark, sf, "call")
    return lead_frequency(scored, broadcast_ok=job.scope.phones.small).select(
        "mobile", "source", "count_source", "count_mobile_number")


def q_frequency_weight(spark, sf):
    job, scored = _scored(spark, sf, "call")
    return repeat_weight(scored, "call", job.scope.phones.small).select(
        "mobile", "source", F.col("repeat_weight").alias("frequency_weight"))


def q_active_score(spark, sf):
    job, p1 = _p1(spark, sf)
    return job.active(p1, rank=False).select(
        "mobile", "customer_id", "source", "society_flag", "days_remaining", "weighted_score")


def q_unscored_leads(spark, sf):
    return _job(spark, sf).unscored()


def _remaining_scored(spark, sf, variant="open"):
    job = _job(spark, sf, variant)
    return score_remaining(job.unscored(), variant, AS_OF, job.scope.phones.small)


def q_unscored_society_flag(spark, sf):
    return _remaining_scored(spark, sf).select("mobile", "pickup_address", "drop_address", "society_flag")


def q_unscored_source_weight(spark, sf):
    return _remaining_scored(spark, sf).select("mobile", "source", "source_weight")


def q_unscored_frequency_weight(spark, sf):
    return _remaining_scored(spark, sf, "call").select(
        "mobile", "source", "count_source", "count_mobile_number",
        F.col("repeat_weight").alias("frequency_weight"))


def q_remaining_score(spark, sf):
    return _job(spark, sf).remaining(rank=False)


def q_ranked_active(spark, sf):
    return with_position(_job(spark, sf, "call").active(rank=False))


def q_ranked_remaining(spark, sf):
    return with_position(_job(spark, sf, "call").remaining(rank=False))


# --- sinks -------------------------------------------------------------------

def q_write_snapshot(spark, sf):
    path = scratch_path(spark, "active-snapshot")
    job = _job(spark, sf)
    write_snapshot(job.remaining(), path)
    write_snapshot(job.active(), path)  # the last one is current
    return read_snapshot(spark, path)


def q_append_history(spark, sf):
    path = scratch_path(spark, "remaining-history")
    df = _job(spark, sf).remaining()
    write_history(df, path, "first", run_time="2024-06-01 23:59:00")
    for day in ("2024-06-01 23:59:30", "2024-06-02 00:01:00"):  # the same run again, past midnight, replaces itself
        write_history(df, path, "second", run_time=day)
    return read_history(spark, path, df.schema).drop("run_time")


# --- pipelines ----------------------------------------------------------------

def q_active_leads_open(spark, sf):
    return _job(spark, sf, "open").active()


def q_remaining_leads_open(spark, sf):
    return _job(spark, sf, "open").remaining()


def q_active_leads_calls(spark, sf):
    return _job(spark, sf, "call").active()


def q_remaining_leads_calls(spark, sf):
    return _job(spark, sf, "call").remaining()


def registry() -> dict[str, Query]:
    return {name[2:]: fn for name, fn in globals().items()
            if name.startswith("q_") and callable(fn)}
