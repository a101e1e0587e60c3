"""Benchmark the headline queries.

Runs each headline query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]``: one warm-up run, then ``$BENCH_RUNS`` timed runs
(default 3), each building the plan and executing it to a no-op sink.  Prints
one JSON line with the median seconds per query and their sum as ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "active_leads_open",
    "remaining_leads_open",
    "active_leads_calls",
    "remaining_leads_calls",
    "customer_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE

    from shiftscore.plans.registry import registry, release_previous
    from shiftscore.session import get_session

    spark = get_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    reg = registry()
    times: dict[str, float] = {}
    for name in names:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            df = reg[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i:
                samples.append(dt)
            release_previous()
            spark.catalog.clearCache()
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
