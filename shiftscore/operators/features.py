"""Customer feature table (O16-O30, O34, O36, O38-O42 = P1).

Shape of the plan, built for a lead list that is small next to the warehouse:

1. Lead phones and then lead customer ids become :class:`KeySet` s.  The lead
   rows and the lead customers are counted once each; when a count proves the
   keys few they are broadcast, so every big relation (orders, inventory logs,
   app logs, app events, sign-ups) is cut to lead-relevant rows by a map-side
   semi join before any shuffle; beyond that a filter of fixed size cuts it
   there.  Filters (status, app names, installed) are pushed into the Parquet
   scan.
2. P1 takes all facts of lead customers as one tagged union and aggregates it
   by customer, day and app, then by customer (:func:`customer_facts`), before
   they meet the fan-out rows of the lead side, so a customer with a third of
   all facts is reduced by partial aggregation instead of being joined row by
   row.  The operators of single facts (O24-O30) stand on their own beside it.
3. Top-1-per-group steps use :func:`first_per_group` (a group limit before the
   shuffle); no step collects an unbounded group.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, ScoringConfig
from ..functions.flags import app_category, base_score, feature_flags, premium_device
from ..functions.keywords import address_match
from ..sources.warehouse import Warehouse
from .joins import KeySet, proven_small
from .topk import first_per_group

COD_KEYS = ["mobile", "source", "app_install_date", "geo_region", "lead_channel_attribution",
            "geo_region_id", "customer_id"]

APP_COUNT_COLUMNS = (
    ("competitor", "competitor_apps_installed"),
    ("luxury", "luxury_apps_installed"),
    ("daily convenience", "daily_convenience_apps_installed"),
    ("E-Commerce", "ecommerce_apps_installed"),
    ("house_shifting", "house_shifting_apps_installed"),
)

APP_COUNT_NAMES = [name for _, name in APP_COUNT_COLUMNS]

FEATURE_COLUMNS = [
    "city", "customer_id", "mobile", "app_install_date", "lead_channel_attribution",
    "last_order_date", "gap_between_app_install_first_order", "total_orders", "order_id",
    "device_model", "mobile_device_type", "trip_keyword_flag", "helper_category_attempts",
    "competitor_apps_installed", "luxury_apps_installed", "daily_convenience_apps_installed",
    "ecommerce_apps_installed", "house_shifting_apps_installed", "app_installed", "vech",
    "drop_location",
]


@dataclass
class LeadScope:
    """Lead phones and the warehouse rows that can matter for them."""

    wh: Warehouse
    phones: KeySet
    customers: DataFrame          # customers rows with a lead phone: id, mobile, geo_region_id
    cfg: ScoringConfig = DEFAULT
    _held: list = field(default_factory=list)
    _customer_ids: KeySet | None = None

    @classmethod
    def build(cls, wh: Warehouse, leads: DataFrame, cfg: ScoringConfig = DEFAULT,
              few: bool | None = None) -> "LeadScope":
        """``few``: whether the lead rows are known to be within the broadcast limit (else they are counted)."""
        few = proven_small(leads, cfg.broadcast_key_limit) if few is None else few
        phones = KeySet(leads, F.col("mobile").cast("string"), few, cfg.key_filter_slots)
        cust = phones.restrict(wh.customers.select("id", "mobile", "geo_region_id"), "mobile")
        cust = cust.persist(StorageLevel.MEMORY_AND_DISK)
        return cls(wh=wh, phones=phones, customers=cust, cfg=cfg, _held=[cust])

    @property
    def customer_ids(self) -> KeySet:
        """Lead customer ids, built on first use (the remaining-lead side never needs them)."""
        if self._customer_ids is None:
            # Counting the lead customers' rows also fills their cache.
            few = proven_small(self.customers, self.cfg.broadcast_key_limit)
            self._customer_ids = KeySet(self.customers, "id", few, self.cfg.key_filter_slots)
            self._held.append(self._customer_ids)
        return self._customer_ids

    def keep(self, df: DataFrame) -> DataFrame:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._held.append(df)
        return df

    def keys(self, df: DataFrame, col, small: bool = False) -> KeySet:
        """Key set of ``df[col]``; ``small`` if it has no more keys than a set already counted."""
        ks = KeySet(df, col, small, self.cfg.key_filter_slots)
        self._held.append(ks)
        return ks

    def release(self) -> None:
        for h in [self.phones, *self._held]:
            h.unpersist() if isinstance(h, DataFrame) else h.release()


# --- O16 -----------------------------------------------------------------

def lead_customers(scope: LeadScope) -> DataFrame:
    """Customer phones among the leads (O16); duplicate customer rows are kept."""
    return scope.customers.select("mobile")


# --- O17, O36, O18 ---------------------------------------------------------

def phone_spots(scope: LeadScope) -> DataFrame:
    """Region and paid flag of every spot of a lead phone: ``number, geo_region, paid``.

    Lead-sized from the start; the spot tables join by measured sizes.
    """
    wh = scope.wh
    phones = scope.phones.restrict(wh.sf_lead_spot_detail_phones.select("number", "detail_id"), "number")
    details = wh.sf_lead_spot_details.select("id", "lead_spot_id", "geo_region_curated")
    attrib = wh.sf_lead_spot_registration_attributions.select("lead_id", "attribution")
    return (phones.join(details, F.col("id") == F.col("detail_id"), "left")
            .join(attrib, F.col("lead_id") == F.col("lead_spot_id"), "left")
            .select("number", F.col("geo_region_curated").alias("geo_region"),
                    F.when(F.col("attribution") == scope.cfg.paid_attribution, F.lit(1)).otherwise(F.lit(0)).alias("paid")))


def lead_signups(scope: LeadScope) -> DataFrame:
    """Sign-ups of lead phones with their local date."""
    shift = F.expr(f"INTERVAL {scope.cfg.local_offset_seconds} SECONDS")
    rows = scope.phones.restrict(
        scope.wh.sf_customer_signup_requests.select("mobile", "source", "request_ts"), "mobile")
    return rows.select("mobile", "source", F.to_date(F.col("request_ts") + shift).alias("app_install_date"))


def install_attribution(scope: LeadScope) -> DataFrame:
    """Sign-ups of lead phones with region and paid-attribution flag, one row for each spot of the phone."""
    return (lead_signups(scope).join(phone_spots(scope), F.col("mobile") == F.col("number"), "left")
            .select("mobile", "source", "app_install_date", "geo_region",
                    F.coalesce("paid", F.lit(0)).alias("lead_channel_attribution")))


def latest_install(scope: LeadScope) -> DataFrame:
    """One sign-up per (phone, source): latest install date, NULL date first.

    Ties on the date go to the paid attribution, then to a NULL region, then to
    the greater region name.  Region and attribution belong to the phone, the
    date to the sign-up, so each side is reduced to one row before they meet:
    a phone with many sign-ups and many spots is never paired with itself.
    """
    date = F.when(F.max(F.col("app_install_date").isNull()), F.lit(None)).otherwise(F.max("app_install_date"))
    dates = lead_signups(scope).groupBy("mobile", "source").agg(date.alias("app_install_date"))
    spot = first_per_group(phone_spots(scope), ["number"], ["paid", "geo_region"], ["paid", "geo_region"], descending=True)
    return (dates.join(spot, F.col("mobile") == F.col("number"), "left")
            .select("mobile", "source", "app_install_date", "geo_region",
                    F.coalesce("paid", F.lit(0)).alias("lead_channel_attribution")))


def customer_installs(scope: LeadScope, latest: DataFrame) -> DataFrame:
    """Lead customers with their latest installs, one row per source."""
    return lead_customers(scope).join(latest, "mobile", "left").select(
        "mobile", "source", "app_install_date", "geo_region", "lead_channel_attribution")


# --- O19/O26 ---------------------------------------------------------------

def install_rows(scope: LeadScope, latest: DataFrame) -> DataFrame:
    """Lead customers with the latest installs of their phone: ``COD_KEYS`` and ``_times``.

    The original joins the customer table twice on the phone (once to find
    lead customers, once for the summary), so a phone shared by N customer
    rows makes N x N rows per install row before grouping, and COUNT sees
    each order N times.  Here equal customer rows are one row from the start,
    each meets its phone's installs once, and ``_times`` is how often the
    original would count each order.  The rows are already one for each group.
    """
    cust = scope.customers.groupBy("mobile", "id", "geo_region_id").agg(F.count(F.lit(1)).alias("_same"))
    dups = scope.customers.groupBy(F.col("mobile").alias("_phone")).agg(F.count(F.lit(1)).alias("_dups"))
    # One row per phone of the counted customer rows.
    dups = F.broadcast(dups) if scope.customer_ids.small else dups
    base = cust.join(dups, F.col("mobile") == F.col("_phone"))
    # A phone without sign-ups keeps one row with NULL install columns.
    return base.join(latest, "mobile", "left").select(
        *[F.col("id").alias(c) if c == "customer_id" else F.col(c) for c in COD_KEYS], (F.col("_same") * F.col("_dups")).alias("_times"))


def order_summary(scope: LeadScope, rows: DataFrame) -> DataFrame:
    """``rows`` with ``_last_pt`` and ``_n`` of their customer -> the order summary's columns."""
    last = F.to_date(F.timestamp_seconds(F.col("_last_pt") + scope.cfg.local_offset_seconds))
    return rows.withColumns({
        "last_order_date": last,
        "gap_between_app_install_first_order": F.datediff(last, F.col("app_install_date")),
        "total_orders": F.col("_times") * F.coalesce(F.col("_n"), F.lit(0))})


def customer_orders(scope: LeadScope, latest: DataFrame) -> DataFrame:
    """Last order date, completed-order count and gap per install row.

    Orders are pre-aggregated per customer (max pickup time, count) before the join.
    """
    orders = scope.customer_ids.restrict(
        scope.wh.orders.where(F.col("status") == scope.cfg.completed_status)
        .select("order_id", "customer_id", "pickup_time"), "customer_id")
    stats = orders.groupBy("customer_id").agg(
        F.max("pickup_time").alias("_last_pt"), F.count("order_id").alias("_n"))
    rows = install_rows(scope, latest).join(stats, "customer_id", "left")
    return order_summary(scope, rows).select(
        *COD_KEYS, "last_order_date", "gap_between_app_install_first_order", "total_orders")


def customer_keys(cod: DataFrame) -> DataFrame:
    """Distinct non-NULL customer ids of the order summary."""
    return cod.select("customer_id").where(F.col("customer_id").isNotNull()).distinct()


# --- O20/O24 ---------------------------------------------------------------

def last_order_keyword(scope: LeadScope, cod: DataFrame) -> DataFrame:
    """Keyword label of the first order on each customer's last order date."""
    cfg = scope.cfg
    last = cod.where(F.col("last_order_date").isNotNull()).select(
        "customer_id", "last_order_date").distinct()
    # One row per lead customer, so the customer-id bound holds for it too.
    last_side = F.broadcast(last) if scope.customer_ids.small else last
    orders = scope.customer_ids.restrict(
        scope.wh.completed_spot_orders_mv.select(
            "order_id", "customer_id", "order_date", "pickup_time", "to_address", "from_address"),
        "customer_id")
    on_last = orders.join(
        last_side, (orders["customer_id"] == last_side["customer_id"])
        & (orders["order_date"] == last_side["last_order_date"]), "left_semi")
    # Pick the order first: the keywords are then looked for in one row per customer.
    first = first_per_group(on_last, ["customer_id"], ["pickup_time", "order_id"],
                            ["order_id", "to_address", "from_address"], descending=False)
    hit = address_match(["to_address", "from_address"], cfg.order_address_keywords)
    label = F.when(hit, F.lit(C.KEYWORD_TRIP)).otherwise(F.lit(C.OTHER_TRIP))
    return last.join(first, "customer_id", "left").select(
        "customer_id", "last_order_date", "order_id", label.alias("trip_keyword_flag"))


# --- O27, O21/O30 ----------------------------------------------------------

def lead_inventory(scope: LeadScope) -> DataFrame:
    """Inventory requests of lead customers: the one scan of the log in P1."""
    return scope.customer_ids.restrict(
        scope.wh.demand_inventory_logging_v2.select("id", "customer_id", "vehicle_id", "drop_location"), "customer_id")


def inventory_summary(scope: LeadScope, rows: DataFrame | None = None) -> DataFrame:
    """Per lead customer: helper-vehicle request count (O27) and highest request id."""
    rows = rows if rows is not None else lead_inventory(scope)
    helper = F.when(F.col("vehicle_id").isin(*scope.cfg.helper_vehicle_ids), F.col("id"))
    return rows.groupBy("customer_id").agg(F.count(helper).alias("_n"), F.max("id").alias("_max_id"))


def helper_attempts(scope: LeadScope, cod: DataFrame,
                    inventory: DataFrame | None = None) -> DataFrame:
    """Helper-vehicle inventory requests per customer, times its summary rows."""
    inv = inventory if inventory is not None else inventory_summary(scope)
    m = (cod.where(F.col("customer_id").isNotNull())
         .groupBy("customer_id").agg(F.count(F.lit(1)).alias("_m")))
    return m.join(inv.select("customer_id", "_n"), "customer_id", "left").select(
        "customer_id", (F.col("_m") * F.coalesce(F.col("_n"), F.lit(0))).alias("helper_category_attempts"))


def latest_vehicle(scope: LeadScope, inventory: DataFrame | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Inventory rows whose id is some lead customer's highest id.

    ``rows`` limits the search to these (P1 drops rows of other customers
    anyway, and passes the lead customers' rows); by default all rows of the
    log are looked at.
    """
    inv = inventory if inventory is not None else inventory_summary(scope)
    ids = inv.select("_max_id").distinct()
    ids = F.broadcast(ids) if scope.customer_ids.small else ids
    rows = rows if rows is not None else scope.wh.demand_inventory_logging_v2.where(F.col("customer_id").isNotNull())
    return rows.join(ids, rows["id"] == ids["_max_id"], "left_semi").select(
        "customer_id", "drop_location", F.col("vehicle_id").alias("vech"))


# --- O38, O28, O29 ---------------------------------------------------------

def app_category_rows(scope: LeadScope) -> DataFrame:
    """Installed listed apps of lead customers with their category."""
    cfg = scope.cfg
    logs = scope.wh.user_application_logs.where(
        F.col("application_name").isin(*cfg.app_names) & F.col("is_installed"))
    logs = logs.select(F.expr("substring(user_type_id, 10)").alias("_id_text"), "application_name")
    # The id list is compared as text, as the original remote query does.
    id_text = scope.keys(scope.customers, F.col("id").cast("string"), small=scope.customer_ids.small)
    logs = id_text.restrict(logs, "_id_text")
    return logs.select(
        F.col("_id_text").try_cast("bigint").alias("customer_id"), "application_name",
        app_category(F.col("application_name"), cfg).alias("app_type"))


def app_summary(scope: LeadScope, rows: DataFrame | None = None) -> DataFrame:
    """Per customer: the five category counts (O28) and the app list.

    Rows are first counted per (customer, app), so a customer has at most one
    row per listed app to gather, whatever the size of the log.  The list keeps
    duplicates and is sorted; each name is repeated as text and rendered
    ``{a,b,c}``, as the original prints it once quotes are stripped.  The
    rendered cell itself grows with the number of log rows.
    """
    rows = rows if rows is not None else app_category_rows(scope)
    per_app = rows.groupBy("customer_id", "application_name", "app_type").agg(
        F.count(F.lit(1)).alias("_n"))
    aggs = [F.sum(F.when(F.col("app_type") == cat, F.col("_n")).otherwise(F.lit(0))).alias(name)
            for cat, name in APP_COUNT_COLUMNS]
    apps = F.array_sort(F.collect_list(F.struct(F.col("application_name").alias("app"), F.col("_n").cast("int").alias("logged"))))
    return per_app.groupBy("customer_id").agg(*aggs, rendered_apps(apps).alias("app_installed"))


def rendered_apps(apps: Column) -> Column:
    """``{a,a,b}`` from an array of (name, count) in order."""
    names = F.transform(apps, lambda x: F.substr(F.repeat(F.concat(F.lit(","), x["app"]), x["logged"]), F.lit(2)))
    return F.concat(F.lit("{"), F.concat_ws(",", names), F.lit("}"))


# --- O25, O39 --------------------------------------------------------------

def _lead_events(scope: LeadScope) -> DataFrame:
    ev = scope.wh.customer_app_events
    tie = [c for c in ("event_id",) if c in ev.columns]
    return scope.customer_ids.restrict(
        ev.select("customer_id", "device_model", "device_platform_name", "event_timestamp", *tie), "customer_id")


def latest_device(scope: LeadScope) -> DataFrame:
    """Device of each lead customer's latest app event, NULL time first."""
    ev = _lead_events(scope)
    return first_per_group(ev, ["customer_id"], [c for c in ("event_timestamp", "event_id") if c in ev.columns],
                           ["device_model", "device_platform_name"], descending=True)


def device_signature(scope: LeadScope, latest: DataFrame | None = None) -> DataFrame:
    """Latest device model and premium flag per customer."""
    latest = latest if latest is not None else latest_device(scope)
    return latest.select(
        "customer_id", "device_model",
        premium_device(F.col("device_platform_name"), F.col("device_model"), scope.cfg)
        .alias("mobile_device_type"))


# --- facts of P1 in one pass -------------------------------------------------

def _ascending(*cols: str) -> list[Column]:
    """Fields that make a struct compare as ASC NULLS LAST."""
    return [x for k, c in enumerate(cols) for x in (F.col(c).isNull().alias(f"_null{k}"), F.col(c))]


FACTS = ("customer_id", "day", "app", "order_time", "order", "trip", "request", "helper", "device")


def fact_rows(scope: LeadScope, inventory: DataFrame) -> DataFrame:
    """Everything known of lead customers as one tagged union.

    Each relation is read once, pruned, filtered and cut to lead customers in
    its own scan stage, and fills its own columns, the rest is NULL: completed
    orders and trips by day, inventory requests, listed apps, device events.
    """
    cfg, wh, ids = scope.cfg, scope.wh, scope.customer_ids
    orders = ids.restrict(wh.orders.where(F.col("status") == cfg.completed_status).select("order_id", "customer_id", "pickup_time"), "customer_id")
    trips = ids.restrict(wh.completed_spot_orders_mv.select(
        "order_id", "customer_id", "order_date", "pickup_time", "to_address", "from_address"), "customer_id")
    events = _lead_events(scope)
    # DESC NULLS FIRST: the greatest struct wins, and a NULL is greater than any value.
    device = F.struct(*_ascending(*[c for c in ("event_timestamp", "event_id") if c in events.columns], "device_model", "device_platform_name"))
    trip = F.struct(*_ascending("pickup_time", "order_id", "to_address", "from_address"))
    types = {f.name: f.dataType for f in trips.select(trip.alias("trip")).schema.fields + events.select(device.alias("device")).schema.fields}
    types |= {"customer_id": "bigint", "day": "date", "app": "string", "order": "int", "helper": "int",
              "order_time": orders.schema["pickup_time"].dataType, "request": inventory.schema["id"].dataType}

    def rows(df: DataFrame, **given: Column) -> DataFrame:
        return df.select(*[given.get(c, F.col(c) if c == "customer_id" else F.lit(None)).cast(types[c]).alias(c) for c in FACTS])

    is_helper = F.col("id").isNotNull() & F.coalesce(F.col("vehicle_id").isin(*cfg.helper_vehicle_ids), F.lit(False))
    return reduce(DataFrame.unionAll, [
        rows(orders, day=F.to_date(F.timestamp_seconds(F.col("pickup_time") + cfg.local_offset_seconds)),
             order_time=F.col("pickup_time"), order=F.col("order_id").isNotNull()),
        rows(trips, day=F.col("order_date"), trip=trip),
        rows(inventory, request=F.col("id"), helper=is_helper),
        rows(app_category_rows(scope), app=F.col("application_name")),
        rows(events, device=device)])


def customer_facts(scope: LeadScope, inventory: DataFrame) -> DataFrame:
    """One row for each lead customer with any fact.

    The union is aggregated by customer, day and app, then by customer: the
    first level is where the facts are shuffled, as one row per group from each
    map task, whatever a customer's share of them.  The trips of the last
    order's day come out of the same pass, since that day's row has both.  A
    customer has at most one row per day and per listed app.
    """
    groups = fact_rows(scope, inventory).groupBy("customer_id", "day", "app").agg(
        F.max("order_time").alias("pt"), F.sum("order").alias("n"), F.min("trip").alias("trip"), F.max("request").alias("request"),
        F.sum("helper").alias("helper"), F.max("device").alias("device"), F.count("app").alias("logged"))
    last = F.max(F.when(F.col("pt").isNotNull(), F.struct("day", "pt", "trip")))
    apps = F.collect_list(F.when(F.col("app").isNotNull(), F.struct("app", F.col("logged").cast("int").alias("logged"))))
    kind = app_category(F.col("app"), scope.cfg)
    return groups.groupBy("customer_id").agg(
        last.alias("last"), F.sum("n").alias("_n"), F.max("request").alias("_max_id"), F.sum("helper").alias("_helper"),
        F.max("device").alias("device"), F.array_sort(apps).alias("apps"),
        *[F.sum(F.when(kind == cat, F.col("logged")).otherwise(F.lit(0))).alias(name) for cat, name in APP_COUNT_COLUMNS])


def fact_columns(scope: LeadScope) -> dict[str, Column]:
    """The feature columns that follow from a row of :func:`customer_facts`."""
    cfg, last, device = scope.cfg, F.col("last"), F.col("device")
    hit = address_match([last["trip"]["to_address"], last["trip"]["from_address"]], cfg.order_address_keywords)
    return {
        "_last_pt": last["pt"], "order_id": last["trip"]["order_id"],
        "trip_keyword_flag": F.when(last.isNotNull(), F.when(hit, F.lit(C.KEYWORD_TRIP)).otherwise(F.lit(C.OTHER_TRIP))),
        **{name: F.coalesce(F.col(name), F.lit(0).cast("bigint")) for _, name in APP_COUNT_COLUMNS},
        "app_installed": F.when(F.size("apps") > 0, rendered_apps(F.col("apps"))),
        "device_model": device["device_model"],
        "mobile_device_type": F.when(device.isNotNull(), premium_device(device["device_platform_name"], device["device_model"], cfg)),
    }


# --- O22, O40, O42 = P1 ----------------------------------------------------

def customer_features(scope: LeadScope, latest: DataFrame | None = None) -> DataFrame:
    """The feature row per install row.

    Install rows meet one row of facts per customer, the region and the
    inventory row of the highest id.
    """
    rows = install_rows(scope, latest if latest is not None else latest_install(scope))
    inventory = scope.keep(lead_inventory(scope))      # the one scan of the log
    facts = scope.keep(customer_facts(scope, inventory))
    vehicle = latest_vehicle(scope, facts, inventory)
    # The region dimension meets a lead-sized table here, so no big side is at
    # stake: AQE broadcasts it from its measured size at run time.
    regions = scope.wh.geo_regions.select(F.col("id").alias("_region_id"), F.col("name").alias("city"))
    # How many summary rows a customer has: one for each install row.  Rows without an id are no group, and are spread.
    own = Window.partitionBy("customer_id", F.when(F.col("customer_id").isNull(), F.xxhash64("mobile", "source")))
    attempts = F.when(F.col("customer_id").isNotNull(), F.count(F.lit(1)).over(own) * F.coalesce(F.col("_helper"), F.lit(0)))
    j = rows.join(facts, "customer_id", "left").withColumns({**fact_columns(scope), "helper_category_attempts": attempts})
    j = order_summary(scope, j)
    return (j.join(regions, F.col("geo_region_id") == F.col("_region_id"), "left")
            .join(vehicle, "customer_id", "left").select(*FEATURE_COLUMNS))


def created_at(as_of: str | None, cfg: ScoringConfig = DEFAULT) -> Column:
    """Run time in India wall time: ``as_of`` (UTC) or now, plus 5.5 hours."""
    base = (F.lit(as_of).cast("timestamp_ntz") if as_of
            else F.current_timestamp().cast("timestamp_ntz"))
    return base + F.expr(f"INTERVAL {cfg.local_offset_seconds} SECONDS")


def customer_score(scope: LeadScope, as_of: str | None = None) -> DataFrame:
    """Feature row + eight flags + base score + created_at."""
    return (customer_features(scope).withColumns(feature_flags())
            .withColumn("weighted_score", base_score(scope.cfg))
            .withColumn("created_at", created_at(as_of, scope.cfg)))
