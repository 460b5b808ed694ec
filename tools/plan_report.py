"""Summarise the physical plan of every registered query.

    python tools/plan_report.py [--sf /root/testdata/sf0.01] [--out PLANS.md] [name ...]

Plans are taken with AQE off, so the static plan (and its whole-stage codegen
spans) is visible; at run time AQE may still coalesce partitions, turn a
sort-merge join into a broadcast from measured sizes, or split skewed ones.
Builders that materialise inputs (checkpoints, written stores) run those steps
while the report is built.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from remitlens.plans import registry  # noqa: E402
from remitlens.session import get_spark  # noqa: E402

OPS = ["ShuffleExchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "Window",
       "WindowGroupLimit", "TakeOrderedAndProject", "MapInPandas", "Generate"]
CODEGEN_OPS = ("Project", "Filter", "Generate", "HashAggregate")


def summarise(plan: str) -> dict:
    lines = plan.splitlines()
    ops = [ln.strip().lstrip(":").strip().lstrip("+-").strip() for ln in lines]
    count = {
        "ShuffleExchange": sum(o.startswith("Exchange") and "SinglePartition" not in o for o in ops),
        "SinglePartition": sum(o.startswith("Exchange SinglePartition") for o in ops),
    }
    for op in OPS[1:]:
        count[op] = sum(re.match(rf"(\*\(\d+\) )?{op}\b", o) is not None for o in ops)
    scans = [o for o in ops if "FileScan" in o or o.startswith("Scan ")]
    count["scans"] = len(scans)
    count["pushed"] = sum("PushedFilters: [" in o and "PushedFilters: []" not in o for o in scans)
    count["no_codegen"] = sum(o.split(" ")[0] in CODEGEN_OPS for o in ops)
    return count


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default=None)
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = get_spark(cpus=8, shuffle_partitions=16, app="remitlens-plans",
                      extra={"spark.sql.adaptive.enabled": "false"})
    qs = registry.queries()
    names = args.names or sorted(qs)
    rows = []
    for name in names:
        df = qs[name](spark, args.sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        rows.append((name, summarise(plan)))
        print(name, rows[-1][1], flush=True)
    cols = ["ShuffleExchange", "SinglePartition", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
            "Window", "WindowGroupLimit", "TakeOrderedAndProject", "MapInPandas", "scans", "pushed", "no_codegen"]
    head = ["query"] + cols
    md = ["| " + " | ".join(head) + " |", "|" + "---|" * len(head)]
    md += ["| " + " | ".join([n] + [str(c[k]) for k in cols]) + " |" for n, c in rows]
    if args.out:
        with open(args.out, "w") as f:
            f.write(HEADER + "\n".join(md) + "\n")


HEADER = """# Plan shapes

Generated by `python tools/plan_report.py --sf /root/testdata/sf0.01 --out PLANS.md` (static plans, AQE off; at run
time AQE may coalesce partitions, broadcast from measured sizes and split skewed joins).

Columns:

- **ShuffleExchange**: hash or range shuffles.
- **SinglePartition**: exchanges into one partition. Each one is a global aggregate of partial results, or a window
  over an already bounded table (offsets or carries, at most `spark.sql.shuffle.partitions` rows; risk and density
  results, at most one row per district or province). None gathers raw rows.
- **BroadcastExchange**: fixed dimensions, explicit bounded hints, or Spark's static size check on small inputs.
- **SortMergeJoin** / **BroadcastHashJoin**: the join strategies planned.
- **Window** / **WindowGroupLimit** / **TakeOrderedAndProject**: windows, per-key top-k trimmed before the shuffle,
  and global top-k without a full sort.
- **MapInPandas**: the only Python step (the settlement fold).
- **scans** / **pushed**: file scans, and how many of them have pushed-down filters.
- **no_codegen**: Project/Filter/Generate/Aggregate operators outside whole-stage codegen (`from_json` only).

"""


if __name__ == "__main__":
    main()
