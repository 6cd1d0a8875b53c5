"""Physical-plan report for every registered query (a developer tool, not part of the library).

Walks the executed plan tree of each query (the final plan of every adaptive node, query-stage
plans, subqueries; cached relations and reused exchanges are counted once and not re-entered) and
counts the operators that matter at scale. Usage:

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import build_session  # noqa: E402

from ledgerline.plans import driver_queries, write_queries  # noqa: E402

QUERIES = driver_queries.QUERIES | write_queries.QUERIES

COLUMNS = {
    "shuffle": ["ShuffleExchangeExec"],
    "broadcast": ["BroadcastExchangeExec"],
    "bhj": ["BroadcastHashJoinExec"],
    "smj": ["SortMergeJoinExec"],
    "shj": ["ShuffledHashJoinExec"],
    "nested_loop": ["BroadcastNestedLoopJoinExec"],
    "cartesian": ["CartesianProductExec"],
    "window": ["WindowExec"],
    "python": ["BatchEvalPythonExec", "ArrowEvalPythonExec", "FlatMapGroupsInPandasExec", "MapInPandasExec"],
    "reused": ["ReusedExchangeExec", "ReusedSubqueryExec"],
    "cached_scan": ["InMemoryTableScanExec"],
    "file_scan": ["FileSourceScanExec"],
}


def _seq(s):
    return [s.apply(i) for i in range(s.size())]


def walk(node, counts: Counter, scans: list) -> None:
    cls = node.getClass().getSimpleName()
    counts[cls] += 1
    if cls == "FileSourceScanExec":
        scans.append(node.toString())
    if cls == "AdaptiveSparkPlanExec":
        walk(node.executedPlan(), counts, scans)
        return
    if cls.endswith("QueryStageExec"):
        walk(node.plan(), counts, scans)
        return
    if cls in ("ReusedExchangeExec", "ReusedSubqueryExec", "InMemoryTableScanExec"):
        return
    for child in _seq(node.children()):
        walk(child, counts, scans)
    for sub in _seq(node.subqueries()):
        walk(sub, counts, scans)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    print(f"# Executed plans ({sf})\n")
    print("Operator counts over each query's executed plan (final adaptive plans, subqueries included; a")
    print("cached frame or a reused exchange counts once). `pushed` = parquet scans with pushed filters.\n")
    print("| query | " + " | ".join(COLUMNS) + " | pushed |")
    print("|---|" + "---|" * (len(COLUMNS) + 1))
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        counts, scans = Counter(), []
        walk(df._jdf.queryExecution().executedPlan(), counts, scans)
        row = [sum(counts[c] for c in cls) for cls in COLUMNS.values()]
        pushed = sum(1 for s in scans if "PushedFilters: [" in s and "PushedFilters: []" not in s)
        print(f"| {name} | " + " | ".join(str(v) for v in row) + f" | {pushed} |")
    spark.stop()


if __name__ == "__main__":
    main()
