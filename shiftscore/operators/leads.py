"""Lead-side operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.nulls import r_ifelse
from ..functions.weights import whatsapp_days

OPEN_LEAD_COLUMNS = ["mobile", "source", "pickup_address", "drop_address", "days_remaining",
                     "order_interests"]
CALL_LEAD_COLUMNS = ["mobile", "source", "pickup_address", "drop_address", "days_remaining"]


def uncalled(leads: DataFrame, status_col: str = "calling_status") -> DataFrame:
    """Leads not called yet (O06): status "Call not done" or empty; NULL status is dropped."""
    return leads.where(F.col(status_col).isin(*C.UNCALLED_STATUSES))


def days_remaining(leads: DataFrame, start_col: str, end_col: str = "shifting_date") -> DataFrame:
    """Whole days from the lead's date to the planned moving date."""
    return leads.withColumn(
        "days_remaining", F.datediff(F.to_date(F.col(end_col)), F.to_date(F.col(start_col))))


def days_remaining_override(leads: DataFrame, answer_col: str = "wa_shifting_date") -> DataFrame:
    """WhatsApp leads take their days from the WhatsApp answer.

    R ``ifelse`` rules: a NULL source gives NULL days; a WhatsApp lead whose
    answer is not one of the three known texts gives NULL days.
    """
    src = F.col("source")
    return leads.withColumn(
        "days_remaining",
        r_ifelse(src == C.WHATSAPP_OVERRIDE_SOURCE, whatsapp_days(F.col(answer_col)),
                 F.col("days_remaining")))


def lead_columns(leads: DataFrame, variant: str) -> DataFrame:
    """Projection the scoring uses."""
    return leads.select(*(OPEN_LEAD_COLUMNS if variant == "open" else CALL_LEAD_COLUMNS))


def prepare_open_leads(leads: DataFrame) -> DataFrame:
    """Open-opportunity sheet -> scoring columns (all rows are kept)."""
    return lead_columns(days_remaining(leads, "created_date"), "open")


def prepare_call_leads(leads: DataFrame) -> DataFrame:
    """Call sheet -> uncalled leads with days, WhatsApp override applied."""
    d = days_remaining(uncalled(leads), "lead_ts")
    return lead_columns(days_remaining_override(d), "call")


def lead_keys(leads: DataFrame) -> DataFrame:
    """Distinct lead phones."""
    return leads.select("mobile").where(F.col("mobile").isNotNull()).distinct()


def scored_leads_join(features: DataFrame, leads: DataFrame) -> DataFrame:
    """Feature rows x lead rows on the phone, whole-row distinct.

    Written as an inner join: every feature row's phone was found through the
    lead phones, so the left join of the original never keeps an unmatched
    row, and an inner join lets AQE split a hot phone on either side.  Each
    side is made distinct before the join, which yields the same rows as a
    distinct after it (a joined row is a pair of side rows) without first
    multiplying the duplicate lead rows of a phone.
    """
    f = features.withColumn("mobile", F.col("mobile").try_cast("bigint")).distinct()
    return f.join(leads.distinct(), "mobile", "inner")


def unscored_leads(leads: DataFrame, scored_mobiles: DataFrame, key_col: str = "key",
                   broadcast_ok: bool = False) -> DataFrame:
    """Distinct leads whose phone got no feature row (O23b), as a left anti join.

    Leads with a NULL phone are kept, as in the original null test.
    """
    k = F.broadcast(scored_mobiles) if broadcast_ok else scored_mobiles
    d = leads.distinct()
    return d.join(k, d["mobile"] == k[key_col], "left_anti")


def lead_frequency(df: DataFrame, mobile_col: str = "mobile", broadcast_ok: bool = False) -> DataFrame:
    """Add ``count_source`` and ``count_mobile_number`` per phone.

    ``count_source`` counts distinct sources with NULL as one source;
    ``count_mobile_number`` counts rows.  Two-level aggregation (partial
    aggregation first, so a hot phone does not land whole in one task), then a
    null-safe join back: a NULL phone is a group of its own, as in dplyr.
    ``broadcast_ok`` says the caller has proven the number of distinct phones
    small (they are a subset of the lead phones, already counted).
    """
    per_source = df.groupBy(mobile_col, "source").agg(F.count(F.lit(1)).alias("_n"))
    counts = per_source.groupBy(mobile_col).agg(
        F.count(F.lit(1)).alias("count_source"),
        F.sum("_n").alias("count_mobile_number"))
    counts = counts.withColumnRenamed(mobile_col, "_m")
    if broadcast_ok:
        counts = F.broadcast(counts)
    j = df.join(counts, df[mobile_col].eqNullSafe(counts["_m"]), "left")
    return j.drop("_m")
