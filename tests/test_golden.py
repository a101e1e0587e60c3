"""Golden counts of FIXTURES.md section 3 (sf0.01, every fifth order a lead).

They come from an independent reading of the original job; matching them
checks our reading, not just agreement between Spark and our own oracle.
"""

import pytest
from pyspark.sql import functions as F

from shiftscore.plans.pipelines import LeadJob
from shiftscore.sources.fixtures import bind_call_leads, bind_open_leads, bind_warehouse

from conftest import SF01

GOLDEN = {
    "open": {"active": (2797, 115337, 2270, 13, 85), "remaining": (429, 16603, 347, 14, 63)},
    "call": {"active": (1398, 43353, 1280, 13, 82), "remaining": (215, 3279, 162, 13, 41)},
}


def summary(df):
    r = df.agg(F.count(F.lit(1)), F.sum("weighted_score"), F.count("weighted_score"),
               F.min("weighted_score"), F.max("weighted_score")).collect()[0]
    return tuple(r)


@pytest.mark.parametrize("variant", ["open", "call"])
def test_golden_scores(spark, variant):
    bind = bind_open_leads if variant == "open" else bind_call_leads
    job = LeadJob.build(bind_warehouse(spark, SF01, edges=False), bind(spark, SF01, lead_stride=5, edges=False), variant,
                        "2024-06-01 00:00:00")
    try:
        assert summary(job.active()) == GOLDEN[variant]["active"]
        assert summary(job.remaining()) == GOLDEN[variant]["remaining"]
    finally:
        job.release()
