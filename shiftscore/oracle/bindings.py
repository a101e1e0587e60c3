"""DuckDB twin of :mod:`shiftscore.sources.fixtures` (the test-data binding).

Each entry is a CTE body over the shared test tables; the oracle prepends
them to every query.  The arithmetic matches the Spark binding exactly.
"""

from __future__ import annotations

from .. import config as C
from ..sources import fixtures as FX


def sql_str(value: str | None) -> str:
    if value is None:
        return "NULL"
    parts = value.split("\t")
    quoted = ["'" + p.replace("'", "''") + "'" for p in parts]
    return " || chr(9) || ".join(quoted)


def sql_list(values) -> str:
    return "[" + ", ".join(sql_str(v) for v in values) + "]"


def pick(values, index_sql: str) -> str:
    return f"{sql_list(values)}[({index_sql}) + 1]"


def epoch_date(seconds_sql: str) -> str:
    """DATE of an epoch-seconds value, in UTC."""
    return f"(DATE '1970-01-01' + CAST(floor(({seconds_sql}) / 86400.0) AS INTEGER))"


def _app_slots():
    names = list(C.DEFAULT.app_names)
    return names + [None] * (FX.APP_SLOTS - len(names))


PICKUP_TIME = "(epoch_us(o_orderdate) // 1000000 + (o_orderkey * 7919) % 86400)"

BINDINGS: dict[str, str] = {
    "customers": f"""
        SELECT c_custkey AS id, CAST({FX.KNOWN_PREFIX} + c_custkey AS VARCHAR) AS mobile,
               c_nationkey AS geo_region_id
        FROM customer
        UNION ALL
        SELECT c_custkey + {FX.SHARED_SHIFT}, CAST({FX.KNOWN_PREFIX} + c_custkey AS VARCHAR), c_nationkey
        FROM customer WHERE c_custkey % {FX.SHARED_PHONE} = 0
        UNION ALL
        SELECT c_custkey + {FX.NO_PHONE_SHIFT}, NULL, c_nationkey FROM customer WHERE c_custkey % {FX.NO_PHONE} = 0""",
    "geo_regions": "SELECT n_nationkey AS id, n_name AS name FROM nation",
    "orders_v": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, {PICKUP_TIME} AS pickup_time,
               CASE WHEN o_orderstatus = 'F' THEN 4 ELSE 1 END AS status
        FROM orders""",
    "completed_spot_orders_mv": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               {epoch_date(PICKUP_TIME + " + " + str(C.LOCAL_OFFSET_SECONDS))} AS order_date,
               {PICKUP_TIME} AS pickup_time,
               {pick(FX.PLACES, "(o_orderkey // 8) % 8")} AS to_address,
               {pick(FX.PLACES, "o_orderkey % 8")} AS from_address
        FROM orders WHERE o_orderstatus = 'F'""",
    "demand_inventory_logging_v2": f"""
        SELECT event_id AS id, user_id AS customer_id, CAST(90 + event_id % 10 AS INTEGER) AS vehicle_id,
               event_type AS drop_location
        FROM events
        UNION ALL
        SELECT event_id, user_id + 1, CAST(90 + event_id % 10 AS INTEGER), 'repeated'
        FROM events WHERE event_id % {FX.REPEATED_ID} = 0""",
    "sf_customer_signup_requests": f"""
        SELECT CAST({FX.KNOWN_PREFIX} + user_id AS VARCHAR) AS mobile,
               {pick(FX.SIGNUP_SOURCES, "event_id % 2")} AS source,
               CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END AS request_ts
        FROM events WHERE event_type = 'signup'""",
    "sf_lead_spot_detail_phones": f"""
        SELECT CAST(CASE WHEN c_custkey % 3 <> 0 THEN {FX.KNOWN_PREFIX} ELSE {FX.NO_SIGNUP_PREFIX} END
                    + c_custkey AS VARCHAR) AS number,
               c_custkey + 1000000 AS detail_id
        FROM customer
        UNION ALL
        SELECT CAST(CASE WHEN c_custkey % 3 <> 0 THEN {FX.KNOWN_PREFIX} ELSE {FX.NO_SIGNUP_PREFIX} END
                    + c_custkey AS VARCHAR), c_custkey + {1000000 + FX.SECOND_SHIFT}
        FROM customer WHERE c_custkey % {FX.SECOND_SPOT} = 0""",
    "sf_lead_spot_details": f"""
        SELECT c_custkey + 1000000 AS id, c_custkey + 2000000 AS lead_spot_id,
               c_mktsegment AS geo_region_curated
        FROM customer
        UNION ALL
        SELECT c_custkey + {1000000 + FX.SECOND_SHIFT}, c_custkey + {2000000 + FX.SECOND_SHIFT}, 'SECOND'
        FROM customer WHERE c_custkey % {FX.SECOND_SPOT} = 0""",
    "sf_lead_spot_registration_attributions": f"""
        SELECT c_custkey + 2000000 AS lead_id,
               CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN {sql_str(C.PAID_ATTRIBUTION)}
                    ELSE 'organic' END AS attribution
        FROM customer
        UNION ALL
        SELECT c_custkey + {2000000 + FX.SECOND_SHIFT}, {sql_str(C.PAID_ATTRIBUTION)}
        FROM customer WHERE c_custkey % {FX.SECOND_PAID} = 0""",
    "user_application_logs": f"""
        SELECT 'customer_' || CAST(user_id AS VARCHAR) AS user_type_id,
               {pick(_app_slots(), f"event_id % {FX.APP_SLOTS}")} AS application_name,
               event_id % 13 = 0 AS is_installed
        FROM events""",
    "customer_app_events": f"""
        SELECT user_id AS customer_id, {pick(FX.DEVICE_MODELS, "event_id % 6")} AS device_model,
               CASE WHEN event_id % 6 = 3 THEN 'iOS' ELSE 'Android' END AS device_platform_name,
               ts AS event_timestamp, event_id
        FROM events""",
}

LEAD_COMMON = f"""
    CASE WHEN o_orderkey % {FX.LEAD_WITHOUT_PHONE} <> 0 THEN
         CASE WHEN o_orderkey % 7 = 0 THEN {FX.UNKNOWN_PREFIX} ELSE {FX.KNOWN_PREFIX} END + o_custkey END AS mobile,
    {pick(FX.LEAD_SOURCES, "o_orderkey % 8")} AS source,
    {pick(FX.PLACES, "o_orderkey % 8")} AS pickup_address,
    CASE WHEN o_orderkey % {FX.LEAD_WITH_TAB} = 0 THEN {sql_str(FX.TAB_ADDRESS)}
         ELSE {pick(FX.PLACES, "(o_orderkey // 8) % 8")} END AS drop_address"""

BINDINGS["open_leads"] = f"""
    SELECT {LEAD_COMMON},
           CAST(o_orderdate AS DATE) + CAST((o_orderkey % 11) % 5 - 1 AS INTEGER) AS shifting_date,
           CAST(o_orderdate AS DATE) AS created_date,
           CAST(CASE WHEN o_orderkey % 13 = 12 THEN NULL ELSE o_orderkey % 13 END AS INTEGER) AS order_interests
    FROM orders"""

BINDINGS["call_leads"] = f"""
    SELECT {LEAD_COMMON},
           o_orderdate AS lead_ts,
           CAST(o_orderdate AS DATE) + CAST((o_orderkey % 11) % 5 - 1 AS INTEGER) AS shifting_date,
           {pick(FX.CALL_STATUSES, "(o_orderkey // 35) % 4")} AS calling_status,
           {pick(FX.WA_ANSWERS, "((o_orderkey // 5) % 9) % 5")} AS wa_shifting_date
    FROM orders"""


def binding_ctes() -> list[tuple[str, str]]:
    return list(BINDINGS.items())
