"""Static physical plan summary of the queries over events (AQE off, so the
plan is the one chosen before run-time re-planning):

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, ".")
from cirrus.plans.events import QUERIES  # noqa: E402
from cirrus.session import build_session  # noqa: E402


def summary(plan: str) -> dict:
    return {
        "scans": plan.count("FileScan parquet"),
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "partial_agg": "partial_" in plan,
        "group_limit": "WindowGroupLimit" in plan,
        "joins": ",".join(sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", plan)))) or "-",
        "python": "yes" if ("ArrowEvalPython" in plan or "MapInPandas" in plan or "BatchEvalPython" in plan) else "no",
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    print("| query | scans | shuffles | partial agg | top-N group limit | joins | Python |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        s = summary(fn(spark, sf)._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['scans']} | {s['shuffles']} | {'yes' if s['partial_agg'] else 'no'} | "
              f"{'yes' if s['group_limit'] else '-'} | {s['joins']} | {s['python']} |")


if __name__ == "__main__":
    main()
