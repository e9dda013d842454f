"""Physical-plan audit of every registered query -> PLANS.md (markdown table).

Counts shuffles by partitioning, broadcasts, join strategies, Python nodes and flags
plan shapes that do not scale (cartesian / nested-loop joins, single-partition
exchanges, unpartitioned windows).  Plans are the final query's plan; writes and
checkpoints a query performs before returning (chunk table, point table, offsets)
are separate jobs and not shown.

Usage: python tests/plan_audit.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def audit(plan: str) -> dict:
    ex = re.findall(r"(?<!Broadcast)Exchange (\w+)", plan)
    kinds = {}
    for k in ex:
        kinds[k] = kinds.get(k, 0) + 1
    flags = [f for f in ("CartesianProduct", "BroadcastNestedLoopJoin") if f in plan]
    single = plan.count("Exchange SinglePartition")
    if single and single > len(re.findall(r"Aggregate\(keys?=\[\], functions=\[partial_", plan)):
        flags.append("SinglePartition exchange without partial aggregation")
    for m in re.finditer(r"Window \[[^\n]*?\], \[([^\]]*)\], \[", plan):
        if not m.group(1).strip():
            flags.append("unpartitioned Window")
    return {
        "shuffles": ", ".join(f"{v} {k}" for k, v in sorted(kinds.items())) or "none",
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(sorted({j for j in re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", plan)})) or "-",
        "topk": "WindowGroupLimit" if "WindowGroupLimit" in plan else "-",
        "python": ", ".join(sorted({p for p in re.findall(r"(ArrowEvalPython|MapInPandas|BatchEvalPython)", plan)})) or "-",
        "pushed": "yes" if re.search(r"PushedFilters: \[[^\]]", plan) else "-",
        "flags": ", ".join(flags) or "-",
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from lectern.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tests/plan_audit.py` at {sf} (AQE initial plans).  Shuffles are the "
          "final query's exchanges; writes/checkpoints done before the query returns are "
          "separate jobs.  `RoundRobinPartitioning` is the rebalance of an under-partitioned "
          "small scan (skipped when a scan already has enough splits); `SinglePartition` is the "
          "final step of a global aggregate after partial aggregation (one row per partition).\n")
    print("| query | shuffles | broadcasts | joins | top-k | python | pushed filters | flags |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in E.queries().items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        a = audit(plan)
        print(f"| {name} | {a['shuffles']} | {a['broadcasts']} | {a['joins']} | {a['topk']} | "
              f"{a['python']} | {a['pushed']} | {a['flags']} |", flush=True)


if __name__ == "__main__":
    main()
