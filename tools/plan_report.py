"""Summarise the physical plans of the headline queries (docs/PLANS.md).

For each query: shuffles (Exchange), broadcasts, join strategies, windows,
Python UDF stages, scans with their pushed filters and read schemas.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarise(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "single_partition": plan.count("Exchange SinglePartition"),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                       r"CartesianProduct)", plan))),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|MapInPandas)", plan)),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan))),
    }


def main():
    from bench import HEADLINE

    from driftwood.plans.registry import queries
    from driftwood.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    qs = queries()
    lines = ["# Physical plans of the headline queries", "",
             f"Generated by `tools/plan_report.py` on `{sf}` (local[8], AQE on; broadcasts at this scale come from",
             "size statistics and would become shuffles on large inputs).", "",
             "| query | shuffles | single-partition | broadcasts | joins | windows | python stages | pushed filters |",
             "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for k in HEADLINE:
        df = qs[k](spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        pushed = "; ".join(p for p in s["pushed"] if p)[:120]
        lines.append(f"| {k} | {s['exchanges']} | {s['single_partition']} | {s['broadcasts']} | "
                     f"{', '.join(s['joins'])} | {s['windows']} | {s['python']} | {pushed} |")
    print("\n".join(lines))


if __name__ == "__main__":
    main()
