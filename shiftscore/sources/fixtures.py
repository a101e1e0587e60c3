"""Binding of the shared test tables to the job's inputs.

The test data is a TPC-H-like star schema plus an ``events`` table; it has no
phones, addresses or app logs.  Every input relation is derived from it by
integer arithmetic that DuckDB evaluates identically (the SQL twin is
:mod:`shiftscore.oracle.bindings`), so the oracle and Spark read the same rows.
Every derived relation keeps all rows of its base table except where the
relation is by meaning a subset (sign-ups are ``signup`` events, completed
orders are status 4).

``edges`` (the default) adds rows of the kinds that the plain binding lacks:
customers that share a phone or have none, phones with two spots, an inventory
id logged for two customers, leads without a phone, an address with a TAB.

``lead_stride`` (default 1: every order is a lead) and ``edges=False`` exist only
so a test can rebuild the lead list documented in FIXTURES.md and compare with
its golden counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .warehouse import Warehouse

# Fixed values of the binding (see FIXTURES.md section 2).
PLACES = ["Prestige Tower", "MG Road", "Lake View", "Sri Aditya Homes", "Depot 7",
          "SOBHA City", "Main Market", "Ring Road"]
LEAD_SOURCES = ["app", "website", "CC Leads", "app_banner", "Missed call", "Whatsapp",
                "WhatsApp", None]
SIGNUP_SOURCES = ["app", "website"]
DEVICE_MODELS = ["SM-G9%", "SM-G991B", "Pixel 6", "iPhone13", "ONEPLUS A6", "Redmi"]
CALL_STATUSES = ["Call not done", "", None, "2024-01-01"]
WA_ANSWERS = ["NOW", "Within 2 Days", "After 2 Days", "", None]
APP_SLOTS = 30          # app name index = event_id % 30; indexes >= 21 have no name
KNOWN_PREFIX = 9000000000
UNKNOWN_PREFIX = 8000000000
NO_SIGNUP_PREFIX = 7000000000
TAB_ADDRESS = "Sri\tAditya"
# Edge rows: every n-th key, and the shift of the ids that they get.
SHARED_PHONE, SHARED_SHIFT = 11, 10000000
NO_PHONE, NO_PHONE_SHIFT = 97, 20000000
SECOND_SPOT, SECOND_SHIFT = 5, 500000
SECOND_PAID = 10
REPEATED_ID = 50
LEAD_WITHOUT_PHONE, LEAD_WITH_TAB = 61, 41

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sql_value(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def pick(values: list, index_sql: str) -> Column:
    """``values[index]`` for a 0-based integer SQL expression."""
    arr = ", ".join(_sql_value(v) for v in values)
    return F.expr(f"array({arr})[CAST(({index_sql}) AS INT)]")


def bind_warehouse(spark: SparkSession, sf_dir: str, edges: bool = True) -> Warehouse:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    orders = read_table(spark, sf_dir, "orders")
    events = read_table(spark, sf_dir, "events")

    customers = customer.select(
        F.col("c_custkey").alias("id"),
        (F.lit(KNOWN_PREFIX) + F.col("c_custkey")).cast("string").alias("mobile"),
        F.col("c_nationkey").alias("geo_region_id"))

    geo_regions = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))

    pickup_time = (F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
                   + (F.col("o_orderkey") * 7919) % 86400)
    oms_orders = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        pickup_time.alias("pickup_time"),
        F.when(F.col("o_orderstatus") == "F", F.lit(4)).otherwise(F.lit(1)).alias("status"))

    completed = (orders.where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date(F.timestamp_seconds(pickup_time + C.LOCAL_OFFSET_SECONDS)).alias("order_date"),
        pickup_time.alias("pickup_time"),
        pick(PLACES, "(o_orderkey div 8) % 8").alias("to_address"),
        pick(PLACES, "o_orderkey % 8").alias("from_address")))

    inventory = events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("customer_id"),
        (F.lit(90) + F.col("event_id") % 10).cast("int").alias("vehicle_id"),
        F.col("event_type").alias("drop_location"))

    signups = (events.where(F.col("event_type") == "signup").select(
        (F.lit(KNOWN_PREFIX) + F.col("user_id")).cast("string").alias("mobile"),
        pick(SIGNUP_SOURCES, "event_id % 2").alias("source"),
        F.when(F.col("event_id") % 17 == 0, F.lit(None)).otherwise(F.col("ts")).alias("request_ts")))

    phones = customer.select(
        (F.when(F.col("c_custkey") % 3 != 0, F.lit(KNOWN_PREFIX)).otherwise(F.lit(NO_SIGNUP_PREFIX))
         + F.col("c_custkey")).cast("string").alias("number"),
        (F.col("c_custkey") + 1000000).alias("detail_id"))

    details = customer.select(
        (F.col("c_custkey") + 1000000).alias("id"),
        (F.col("c_custkey") + 2000000).alias("lead_spot_id"),
        F.col("c_mktsegment").alias("geo_region_curated"))

    attributions = customer.select(
        (F.col("c_custkey") + 2000000).alias("lead_id"),
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(C.PAID_ATTRIBUTION))
        .otherwise(F.lit("organic")).alias("attribution"))

    app_slots = list(C.DEFAULT.app_names) + [None] * (APP_SLOTS - len(C.DEFAULT.app_names))
    app_logs = events.select(
        F.concat(F.lit("customer_"), F.col("user_id").cast("string")).alias("user_type_id"),
        pick(app_slots, f"event_id % {APP_SLOTS}").alias("application_name"),
        (F.col("event_id") % 13 == 0).alias("is_installed"))

    app_events = events.select(
        F.col("user_id").alias("customer_id"),
        pick(DEVICE_MODELS, "event_id % 6").alias("device_model"),
        F.when(F.col("event_id") % 6 == 3, F.lit("iOS")).otherwise(F.lit("Android"))
        .alias("device_platform_name"),
        F.col("ts").alias("event_timestamp"),
        F.col("event_id"))

    if edges:
        k = F.col("c_custkey")
        customers = customers.union(customer.where(k % SHARED_PHONE == 0).select(
            k + SHARED_SHIFT, (F.lit(KNOWN_PREFIX) + k).cast("string"), "c_nationkey"))
        customers = customers.union(customer.where(k % NO_PHONE == 0).select(
            k + NO_PHONE_SHIFT, F.lit(None).cast("string"), "c_nationkey"))
        second = customer.where(k % SECOND_SPOT == 0)
        number = F.when(k % 3 != 0, F.lit(KNOWN_PREFIX)).otherwise(F.lit(NO_SIGNUP_PREFIX)) + k
        phones = phones.union(second.select(number.cast("string"), k + 1000000 + SECOND_SHIFT))
        details = details.union(second.select(k + 1000000 + SECOND_SHIFT, k + 2000000 + SECOND_SHIFT, F.lit("SECOND")))
        attributions = attributions.union(customer.where(k % SECOND_PAID == 0).select(
            k + 2000000 + SECOND_SHIFT, F.lit(C.PAID_ATTRIBUTION)))
        inventory = inventory.union(events.where(F.col("event_id") % REPEATED_ID == 0).select(
            "event_id", F.col("user_id") + 1, (F.lit(90) + F.col("event_id") % 10).cast("int"), F.lit("repeated")))

    return Warehouse(
        customers=customers, orders=oms_orders, completed_spot_orders_mv=completed,
        demand_inventory_logging_v2=inventory, geo_regions=geo_regions,
        sf_customer_signup_requests=signups, sf_lead_spot_detail_phones=phones,
        sf_lead_spot_details=details, sf_lead_spot_registration_attributions=attributions,
        user_application_logs=app_logs, customer_app_events=app_events)


def _lead_base(spark: SparkSession, sf_dir: str, lead_stride: int) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    if lead_stride != 1:
        orders = orders.where(F.col("o_orderkey") % lead_stride == 0)
    return orders


def _lead_common(k: Column, edges: bool) -> list[Column]:
    mobile = F.when(k % 7 == 0, F.lit(UNKNOWN_PREFIX)).otherwise(F.lit(KNOWN_PREFIX)) + F.col("o_custkey")
    drop = pick(PLACES, "(o_orderkey div 8) % 8")
    if edges:
        mobile = F.when(k % LEAD_WITHOUT_PHONE != 0, mobile)
        drop = F.when(k % LEAD_WITH_TAB == 0, F.lit(TAB_ADDRESS)).otherwise(drop)
    return [
        mobile.alias("mobile"),
        pick(LEAD_SOURCES, "o_orderkey % 8").alias("source"),
        pick(PLACES, "o_orderkey % 8").alias("pickup_address"),
        drop.alias("drop_address"),
    ]


def bind_open_leads(spark: SparkSession, sf_dir: str, lead_stride: int = 1, edges: bool = True) -> DataFrame:
    """Open-opportunity lead sheet, normalised names (see sources.leads)."""
    k = F.col("o_orderkey")
    created = F.to_date(F.col("o_orderdate"))
    return _lead_base(spark, sf_dir, lead_stride).select(
        *_lead_common(k, edges),
        F.date_add(created, ((k % 11) % 5 - 1).cast("int")).alias("shifting_date"),
        created.alias("created_date"),
        F.when(k % 13 == 12, F.lit(None)).otherwise(k % 13).cast("int").alias("order_interests"))


def bind_call_leads(spark: SparkSession, sf_dir: str, lead_stride: int = 1, edges: bool = True) -> DataFrame:
    """Call-sheet lead list, normalised names (see sources.leads)."""
    k = F.col("o_orderkey")
    created = F.to_date(F.col("o_orderdate"))
    return _lead_base(spark, sf_dir, lead_stride).select(
        *_lead_common(k, edges),
        F.col("o_orderdate").alias("lead_ts"),
        F.date_add(created, ((k % 11) % 5 - 1).cast("int")).alias("shifting_date"),
        pick(CALL_STATUSES, "(o_orderkey div 35) % 4").alias("calling_status"),
        pick(WA_ANSWERS, "((o_orderkey div 5) % 9) % 5").alias("wa_shifting_date"))
