"""Summarise executed physical plans of headline queries (writes PLANS.md).

For each query: operator counts (joins by strategy and type, exchanges,
aggregates, sorts), and every Parquet scan with its pushed filters and read
schema.  Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import collections
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NAMES = ["active_leads_open", "remaining_leads_calls", "customer_score"]
OPS = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "Exchange hashpartitioning", "Exchange rangepartitioning",
       "Exchange RoundRobinPartitioning", "Exchange SinglePartition", "BroadcastExchange",
       "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Sort ", "Window",
       "InMemoryTableScan", "BatchEvalPython", "ArrowEvalPython"]


def walk(node, cached: list):
    """Nodes of the final physical plan: query stages are descended into;
    a cached table (InMemoryTableScan) is a leaf, its own plan is queued in
    ``cached`` to be reported once."""
    cls = node.getClass().getSimpleName()
    yield node
    if cls == "AdaptiveSparkPlanExec":
        yield from walk(node.executedPlan(), cached)
        return
    if cls in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec",
               "TableCacheQueryStageExec"):
        yield from walk(node.plan(), cached)
        return
    if cls == "InMemoryTableScanExec":
        cached.append(node.relation().cachedPlan())
        return
    if cls == "ReusedExchangeExec":
        return
    kids = node.children()
    for i in range(kids.size()):
        yield from walk(kids.apply(i), cached)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from shiftscore.plans.registry import registry, release_previous
    from shiftscore.session import get_session

    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Executed plans ({os.path.basename(sf)}, local[8], AQE final plans)\n")
    print("Generated by `tools/plan_report.py` from the executed (AQE final) plans. "
          "Cached intermediates (lead list, key sets, lead customers, order summary, ...) are "
          "counted once in their own column. Join types in brackets; partitioning class "
          "after Exchange.\n")
    for name_q in NAMES:
        release_previous()
        df = registry()[name_q](spark, sf)
        df.collect()
        root = df._jdf.queryExecution().executedPlan()
        counts = collections.Counter()
        cache_counts = collections.Counter()
        scans = []
        queue, seen = [], set()
        nodes = [(n, counts) for n in walk(root, queue)]
        while queue:
            plan = queue.pop()
            key = plan.toString()
            if key in seen:
                continue
            seen.add(key)
            nodes += [(n, cache_counts) for n in walk(plan, queue)]
        for node, bucket in nodes:
            name = node.nodeName()
            if name.endswith("Join") or name in ("BroadcastNestedLoopJoin", "CartesianProduct"):
                try:
                    name = f"{name} [{node.joinType().toString()}]"
                except Exception:
                    pass
            elif name in ("Exchange", "ShuffleExchange"):
                name = "Exchange " + node.outputPartitioning().getClass().getSimpleName()
            elif name.startswith("Scan parquet") or "FileScan" in node.getClass().getSimpleName() \
                    or node.getClass().getSimpleName() == "FileSourceScanExec":
                text = node.simpleString(10000)
                table = re.search(r"testdata/[^/]+/([a-z_]+)\.parquet", text)
                pushed = re.search(r"PushedFilters: (\[[^\]]*\])", text)
                schema = re.search(r"ReadSchema: (struct<[^>]*>)", text)
                scans.append((table.group(1) if table else "?", pushed.group(1) if pushed else "",
                              schema.group(1) if schema else ""))
                name = "FileSourceScan parquet"
            if name.startswith("WholeStageCodegen"):
                name = "WholeStageCodegen stage"
            if name in ("WholeStageCodegen", "InputAdapter", "ColumnarToRow", "Project", "Filter",
                        "AdaptiveSparkPlan", "ShuffleQueryStage", "BroadcastQueryStage",
                        "ResultQueryStage", "AQEShuffleRead"):
                continue
            bucket[name] += 1
        print(f"## {name_q}\n")
        print(f"{len(seen)} cached intermediates, each computed once.\n")
        print("| operator | in the final plan | in cached intermediates |\n| --- | --- | --- |")
        for k in sorted(set(counts) | set(cache_counts)):
            print(f"| {k} | {counts.get(k, 0)} | {cache_counts.get(k, 0)} |")
        print()
        print("| scan | pushed filters | read schema |\n| --- | --- | --- |")
        for t, p, s in sorted(set(scans)):
            print(f"| {t} | `{p}` | `{s}` |")
        print()


if __name__ == "__main__":
    main()
