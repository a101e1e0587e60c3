"""End-to-end jobs.

``open`` is the open-opportunity variant (interest-count weight), ``call``
the call-sheet variant (uncalled filter, WhatsApp days, lead-repetition
weight).  Both produce an *active* table (leads found in the customer base,
scored with customer features) and a *remaining* table (leads not found,
scored from lead-side weights only).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..functions.keywords import lead_address_match
from ..functions.weights import (frequency_weight, interest_weight, society_flag,
                                 source_weight, unscored_society_flag, urgency_weight)
from ..operators.features import LeadScope, created_at, customer_score
from ..operators.joins import proven_small
from ..operators.leads import (lead_frequency, prepare_call_leads, prepare_open_leads,
                               scored_leads_join, unscored_leads)
from ..operators.ranking import rank_by_score
from ..session import utc_now
from ..sources.warehouse import Warehouse

ACTIVE_COLUMNS = [
    "mobile", "city", "customer_id", "app_install_date", "lead_channel_attribution",
    "last_order_date", "total_orders", "device_model", "trip_keyword_flag",
    "helper_category_attempts", "competitor_apps_installed", "luxury_apps_installed",
    "daily_convenience_apps_installed", "ecommerce_apps_installed",
    "house_shifting_apps_installed", "app_installed", "source", "society_flag",
    "days_remaining", "weighted_score", "created_at",
]
# Feature columns the active table needs, plus the inventory columns, which
# are not functions of the customer when inventory ids repeat.
SCORED_FEATURE_COLUMNS = [
    "mobile", "city", "customer_id", "app_install_date", "lead_channel_attribution",
    "last_order_date", "total_orders", "device_model", "trip_keyword_flag",
    "helper_category_attempts", "competitor_apps_installed", "luxury_apps_installed",
    "daily_convenience_apps_installed", "ecommerce_apps_installed",
    "house_shifting_apps_installed", "app_installed", "trip_flag", "weighted_score",
    "created_at", "vech", "drop_location",
]
REMAINING_COLUMNS = [
    "mobile", "source", "pickup_address", "drop_address", "society_flag", "days_remaining",
    "weighted_score", "created_at",
]


def prepare_leads(leads: DataFrame, variant: str) -> DataFrame:
    if variant == "open":
        return prepare_open_leads(leads)
    if variant == "call":
        return prepare_call_leads(leads)
    raise ValueError(f"unknown variant {variant!r}")


def lead_match(cfg: ScoringConfig = DEFAULT):
    return lead_address_match("pickup_address", "drop_address",
                              cfg.lead_pickup_keywords, cfg.lead_drop_keywords)


def repeat_weight(df: DataFrame, variant: str, phones_small: bool = False) -> DataFrame:
    """Interest weight (open) or lead-repetition weight (call) as ``repeat_weight``.

    ``phones_small``: the lead phones were proven few enough to broadcast; the
    per-phone counts have at most that many rows (plus one NULL phone).
    """
    if variant == "open":
        return df.withColumn("repeat_weight", interest_weight(F.col("order_interests")))
    df = lead_frequency(df, broadcast_ok=phones_small)
    return df.withColumn("repeat_weight",
                         frequency_weight(F.col("count_source"), F.col("count_mobile_number")))


def score_active(scored: DataFrame, variant: str, cfg: ScoringConfig = DEFAULT,
                 phones_small: bool = False) -> DataFrame:
    """Lead-side weights on the scored join (O41, O44-O48); NULL terms give a NULL score."""
    df = scored.withColumns({
        "source_weight": source_weight(F.col("source")),
        "society_flag": society_flag(lead_match(cfg), F.col("trip_flag")),
        "urgency_weight": urgency_weight(F.col("days_remaining")),
    })
    df = repeat_weight(df, variant, phones_small)
    total = (F.col("weighted_score") + F.col("society_flag") * cfg.society_weight
             + F.col("repeat_weight") + F.col("source_weight") + F.col("urgency_weight"))
    return df.withColumn("weighted_score", total)


def score_remaining(unscored: DataFrame, variant: str, as_of: str | None,
                    phones_small: bool = False, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """Lead-side-only score for leads without a customer.

    The original writes the source test with a scalar ``||`` that reads a
    different table; the evident intent, the same rule as the scored side,
    is built instead.
    """
    df = unscored.withColumns({
        "society_flag": unscored_society_flag(lead_match(cfg)),
        "source_weight": source_weight(F.col("source")),
        "urgency_weight": urgency_weight(F.col("days_remaining")),
    })
    df = repeat_weight(df, variant, phones_small)
    total = (F.col("source_weight") + F.col("society_flag") * cfg.society_weight
             + F.col("urgency_weight") + F.col("repeat_weight"))
    return df.withColumn("weighted_score", total).withColumn("created_at", created_at(as_of, cfg))


@dataclass
class LeadJob:
    """One run: the prepared leads and the lead scope over the warehouse.

    Holds cached tables until ``release()``, or the end of a ``with`` block.
    """

    leads: DataFrame
    scope: LeadScope
    variant: str
    as_of: str
    cfg: ScoringConfig

    @classmethod
    def build(cls, wh: Warehouse, raw_leads: DataFrame, variant: str, as_of: str | None = None,
              cfg: ScoringConfig = DEFAULT, persist_leads: bool = True) -> "LeadJob":
        as_of = as_of or utc_now()  # one time for all tables of the run
        leads = prepare_leads(raw_leads, variant)
        # The sheet's rows bound the number of lead phones; counting them moves nothing.
        few = proven_small(leads, cfg.broadcast_key_limit)
        # Every use of the lead list below (scored join, unscored anti join,
        # lead phones) comes after a whole-row distinct, so deduplicate once.
        # Hash partitioning on all columns spreads a hot phone's rows over the
        # partitions; AQE sizes them, and later distincts need no shuffle.
        leads = leads.repartition(*leads.columns).distinct()
        if persist_leads:
            leads = leads.persist()
        scope = LeadScope.build(wh, leads, cfg, few)
        if persist_leads:
            scope._held.append(leads)
        return cls(leads=leads, scope=scope, variant=variant, as_of=as_of, cfg=cfg)

    def customer_score(self) -> DataFrame:
        """P1."""
        return customer_score(self.scope, self.as_of)

    def scored(self, features: DataFrame | None = None, narrow: bool = False) -> DataFrame:
        """Feature rows joined to the leads, distinct.

        ``narrow`` keeps only what scoring reads plus the inventory columns,
        before the distinct.  The columns left out are functions of kept
        ones (gap of the two dates, order id and device flag of the customer,
        flags of the counts), so the distinct rows are the same, projected.
        """
        f = features if features is not None else self.customer_score()
        if narrow:
            f = f.select(*SCORED_FEATURE_COLUMNS)
        return scored_leads_join(f, self.leads)

    def active(self, features: DataFrame | None = None, rank: bool = True) -> DataFrame:
        """P2 / P4."""
        scored = self.scored(features, narrow=True)
        if self.variant == "call":
            # Read twice by the repetition counts (aggregate, then join back):
            # compute the feature join once.
            scored = self.scope.keep(scored)
        df = score_active(scored, self.variant, self.cfg,
                          self.scope.phones.small).select(*ACTIVE_COLUMNS)
        return rank_by_score(df) if rank else df

    def unscored(self) -> DataFrame:
        """Distinct leads whose phone is not a customer phone.

        A feature row exists for exactly the lead phones found in the
        customer table, so the anti join runs against those phones directly
        and does not wait for the feature build.
        """
        found = self.scope.keys(self.scope.customers, F.col("mobile").try_cast("bigint"),
                                small=self.scope.phones.small)
        return unscored_leads(self.leads, found.frame, "key", broadcast_ok=found.small)

    def remaining(self, rank: bool = True) -> DataFrame:
        """P3 / P5."""
        unscored = self.unscored()
        if self.variant == "call":
            unscored = self.scope.keep(unscored)
        df = score_remaining(unscored, self.variant, self.as_of,
                             self.scope.phones.small, self.cfg)
        df = df.select(*REMAINING_COLUMNS)
        return rank_by_score(df) if rank else df

    def release(self) -> None:
        self.scope.release()

    def __enter__(self) -> "LeadJob":
        return self

    def __exit__(self, *exc) -> None:
        self.release()
