"""Physical-plan summary of registered queries (after one execution, so AQE
decisions such as broadcasts are final).

Usage: python tools/plan_summary.py [sf_dir] [query ...]  -> markdown table
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlewick.plans.catalog import QUERIES  # noqa: E402
from candlewick.session import build_session  # noqa: E402

OPS = {
    "shuffles": r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)",
    "hash agg": r"\bHashAggregate\b",
    "sort agg": r"\bSortAggregate\b",
    "window": r"\bWindow \[",
    "group limit": r"\bWindowGroupLimit\b",
    "broadcast join": r"\bBroadcastHashJoin\b",
    "sort-merge join": r"\bSortMergeJoin\b",
    "top-k": r"\bTakeOrderedAndProject\b",
}


def summarize(plan: str) -> dict[str, str]:
    row = {k: str(len(re.findall(v, plan))) for k, v in OPS.items()}
    schemas = sorted(set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)))
    row["scan columns"] = "; ".join(",".join(c.split(":")[0] for c in s.split(",")) for s in schemas)
    pushed = sorted(set(p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p))
    row["pushed filters"] = "; ".join(pushed) or "-"
    return row


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(QUERIES)
    spark = build_session("local[8]")
    header = ["query"] + list(OPS) + ["scan columns", "pushed filters"]
    print("| " + " | ".join(header) + " |")
    print("|" + "---|" * len(header))
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        row = summarize(df._jdf.queryExecution().executedPlan().toString())
        print("| " + " | ".join([name] + [row[h] for h in header[1:]]) + " |", flush=True)


if __name__ == "__main__":
    main()
