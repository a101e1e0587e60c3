"""The eleven warehouse relations the job reads.

On a cluster these are catalog tables or Parquet folders; ``load_warehouse``
reads them with column pruning left to Catalyst (only the columns a plan
selects reach ``ReadSchema``).  A live database is read in parallel by the
``reader`` of :mod:`.jdbc`.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

RELATIONS = (
    "customers",                                 # id, mobile, geo_region_id
    "orders",                                    # order_id, customer_id, pickup_time, status
    "completed_spot_orders_mv",                  # order_id, customer_id, order_date, pickup_time, to_address, from_address
    "demand_inventory_logging_v2",               # id, customer_id, vehicle_id, drop_location
    "geo_regions",                               # id, name
    "sf_customer_signup_requests",               # mobile, source, request_ts
    "sf_lead_spot_detail_phones",                # number, detail_id
    "sf_lead_spot_details",                      # id, lead_spot_id, geo_region_curated
    "sf_lead_spot_registration_attributions",    # lead_id, attribution
    "user_application_logs",                     # user_type_id, application_name, is_installed
    "customer_app_events",                       # customer_id, device_model, device_platform_name, event_timestamp[, event_id]
)


@dataclass
class Warehouse:
    customers: DataFrame
    orders: DataFrame
    completed_spot_orders_mv: DataFrame
    demand_inventory_logging_v2: DataFrame
    geo_regions: DataFrame
    sf_customer_signup_requests: DataFrame
    sf_lead_spot_detail_phones: DataFrame
    sf_lead_spot_details: DataFrame
    sf_lead_spot_registration_attributions: DataFrame
    user_application_logs: DataFrame
    customer_app_events: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


def load_warehouse(spark: SparkSession, root: str | None = None, *,
                   reader: Callable[[str], DataFrame] | None = None,
                   fmt: str = "parquet") -> Warehouse:
    """Read the eleven relations, by name, from ``root/<name>`` or a reader."""
    if reader is None:
        if root is None:
            raise ValueError("give root or reader")

        def reader(name: str) -> DataFrame:
            return spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}")
    return Warehouse(**{name: reader(name) for name in RELATIONS})
