"""Summarise the physical plan of every registered query into PLANS.md.

Counts shuffles, broadcasts, partial aggregates, partial window group limits,
generators and Python steps, flags any nested-loop or cartesian join, and
lists what each Parquet scan reads.  Streaming queries run their stream when
called, so they are summarised from their batch equivalents.

Usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from folio.plans.catalog import QUERIES  # noqa: E402
from folio.session import local_session  # noqa: E402

SKIP = {"stream_ingest", "stream_questions"}


def summarise(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "partial_aggs": len(re.findall(r"HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan))
        + len(re.findall(r"ObjectHashAggregate\(keys=\[[^\]]*\], functions=\[partial_", plan)),
        "group_limit_partial": plan.count("WindowGroupLimit") and len(re.findall(r"WindowGroupLimit.*Partial", plan)),
        "generators": plan.count("Generate "),
        "python": plan.count("MapInPandas") + plan.count("ArrowEvalPython"),
        "nested_loop_or_cartesian": plan.count("BroadcastNestedLoopJoin") + plan.count("CartesianProduct"),
        "joins": ", ".join(sorted(set(re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", plan)))) or "-",
        "reads": "; ".join(sorted(set(
            f"{m.group(1)}({m.group(2)})" for m in re.finditer(r"Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet\].*?ReadSchema: struct<([^>]*)>", plan)
        ))),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("# PLANS\n")
    print("Physical plans (adaptive execution's initial plan) of the registered queries at "
          f"`{os.path.basename(sf)}`, produced by `tools/plan_summary.py`.  A nested-loop or cartesian "
          "join count other than 0 would be a bug.\n")
    print("| query | shuffles | broadcasts | partial aggs | partial group limits | generators | python steps | "
          "nested-loop/cartesian | joins | scans (columns read) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in QUERIES.items():
        if name in SKIP:
            continue
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['partial_aggs']} | {s['group_limit_partial']} | "
              f"{s['generators']} | {s['python']} | {s['nested_loop_or_cartesian']} | {s['joins']} | {s['reads']} |")
    spark.stop()


if __name__ == "__main__":
    main()
