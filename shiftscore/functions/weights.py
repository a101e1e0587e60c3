"""Lead-side weights (O44-O47, O41, O50) as Spark column expressions.

R null rules apply here (see :mod:`.nulls`): a NA test yields NA, except
where the script explicitly replaces NA (urgency) or uses ``%ilike%``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C
from .nulls import r_ifelse


def source_weight(source: Column) -> Column:
    """5 for high-intent channels, 3 for mid, 1 otherwise; NULL source -> NULL.

    Case-sensitive on purpose: ``Whatsapp`` weighs 3, ``WhatsApp`` weighs 1.
    """
    hi, mid, low = C.SOURCE_WEIGHTS
    return r_ifelse(source.isin(*C.HIGH_SOURCES), F.lit(hi),
                    r_ifelse(source.isin(*C.MID_SOURCES), F.lit(mid), F.lit(low)))


def urgency_weight(days: Column) -> Column:
    """0 days -> 5, 1 -> 3, >=2 -> 1, anything else (negative, NULL) -> 0."""
    return (F.when(days == 0, F.lit(5)).when(days == 1, F.lit(3))
            .when(days >= 2, F.lit(1)).otherwise(F.lit(0)))


def interest_weight(interests: Column) -> Column:
    """Weight from the count of order interests (open-opportunity leads).

    >=10 -> 10, 2 or 3 -> 30, every other number -> 50, NULL -> NULL.  The
    original third test ``>=4 | <=6`` holds for every number, so its later
    branches cannot be reached; this is the reduced, equivalent form.
    """
    return r_ifelse(interests >= 10, F.lit(10),
                    F.when(interests.isin(2, 3), F.lit(30)).otherwise(F.lit(50)))


def frequency_weight(count_source: Column, count_rows: Column) -> Column:
    """Weight from lead repetition (call-sheet leads).

    One source or >=10 rows -> 10; 2-3 sources and 2-3 rows -> 30; else 50.
    Counts are never NULL; the original tail tests are always true for
    non-NULL counts, so the 0 branch cannot be reached.
    """
    return r_ifelse((count_source == 1) | (count_rows >= 10), F.lit(10),
                    r_ifelse(count_source.isin(2, 3) & count_rows.isin(2, 3), F.lit(30),
                             F.lit(50)))


def society_flag(lead_match: Column, trip_flag: Column) -> Column:
    """Scored leads: an address keyword on the lead gives 1, else the order-side flag."""
    return F.when(lead_match, F.lit(1)).otherwise(trip_flag)


def unscored_society_flag(lead_match: Column) -> Column:
    """Unscored leads: no order history to fall back on."""
    return F.when(lead_match, F.lit(1)).otherwise(F.lit(0))


def whatsapp_days(answer: Column) -> Column:
    """Days-to-move from the WhatsApp answer; other answers give NULL."""
    expr = None
    for text, days in C.WHATSAPP_DAYS:
        expr = (F.when(answer == text, F.lit(days)) if expr is None
                else expr.when(answer == text, F.lit(days)))
    return expr.otherwise(F.lit(None).cast("int"))
