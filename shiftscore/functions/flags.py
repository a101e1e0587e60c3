"""Customer-side feature flags and the base score."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT, ScoringConfig


def app_category(app_name: Column, cfg: ScoringConfig = DEFAULT) -> Column:
    """Category of an installed app; NULL for names outside the list."""
    expr = None
    for cat, names in cfg.app_categories:
        cond = app_name.isin(*names)
        expr = F.when(cond, F.lit(cat)) if expr is None else expr.when(cond, F.lit(cat))
    return expr


def premium_device(platform: Column, model: Column, cfg: ScoringConfig = DEFAULT) -> Column:
    """1 for the premium platform or a listed model, else 0 (NULL -> 0).

    The model list is compared literally, as an IN list; pass
    ``premium_models_as_patterns=True`` to treat the entries as LIKE patterns.
    """
    if cfg.premium_models_as_patterns:
        model_hit = reduce(lambda a, b: a | b, [model.like(p) for p in cfg.premium_device_models])
    else:
        model_hit = model.isin(*cfg.premium_device_models)
    return F.when((platform == cfg.premium_platform) | model_hit, F.lit(1)).otherwise(F.lit(0))


def positive_flag(count: Column) -> Column:
    return F.when(count > 0, F.lit(1)).otherwise(F.lit(0))


def feature_flags() -> dict[str, Column]:
    """The eight 0/1 flags derived from the feature row."""
    return {
        "luxury_apps_flag": positive_flag(F.col("luxury_apps_installed")),
        "competitor_apps_flag": positive_flag(F.col("competitor_apps_installed")),
        "daily_convenience_apps_flag": positive_flag(F.col("daily_convenience_apps_installed")),
        "ecommerce_apps_flag": positive_flag(F.col("ecommerce_apps_installed")),
        "house_shifting_apps_flag": positive_flag(F.col("house_shifting_apps_installed")),
        "helper_flag": positive_flag(F.col("helper_category_attempts")),
        "lto_0_flag": F.when(F.col("total_orders") > 0, F.lit(0)).otherwise(F.lit(1)),
        "trip_flag": F.when(F.col("trip_keyword_flag") == C.KEYWORD_TRIP, F.lit(1)).otherwise(F.lit(0)),
    }


def base_score(cfg: ScoringConfig = DEFAULT) -> Column:
    """Weighted sum of the flags, NULL terms counted as 0 (range 0-27 by default)."""
    terms = [F.coalesce(F.col(c), F.lit(0)) * F.lit(w) for c, w in cfg.base_weights]
    return reduce(lambda a, b: a + b, terms)
