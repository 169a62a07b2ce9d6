"""Print the physical-plan profile of every catalogue query.

Usage: python tools/plan_report.py [sf_dir] [name ...]
Counts shuffle exchanges (and whether one moves whole candle rows),
broadcasts, Python stages, aggregate kinds and window-group limits of the
final executed plan (building a query may run its checkpoint jobs).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlewick.plans.catalogue import QUERIES  # noqa: E402
from candlewick.session import get_spark  # noqa: E402

KINDS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "BroadcastExchange", "FlatMapCoGroupsInPandas", "FlatMapGroupsInPandas",
         "HashAggregate", "ObjectHashAggregate", "SortAggregate", "WindowGroupLimit", "Window ",
         "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"]


def profile(plan: str) -> dict:
    lines = plan.splitlines()
    out = {k.strip(): sum(k in ln for ln in lines) for k in KINDS}
    rows = halo = 0
    for i, ln in enumerate(lines):
        if "Exchange hashpartitioning" in ln and i + 1 < len(lines) \
                and re.search(r"\bdatetime#", lines[i + 1]) and re.search(r"\bclose#", lines[i + 1]):
            below = lines[i + 1:i + 8]
            if any("Filter" in b and "_t#" in b for b in below):
                halo += 1   # only the halo rows (tail of each block) move
            else:
                rows += 1
    out["row_shuffles"], out["halo_shuffles"] = rows, halo
    return {k: v for k, v in out.items() if v}


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or list(QUERIES)
    spark = get_spark("local[8]", 8)
    for name in names:
        df = QUERIES[name].spark(spark, sf)
        print(f"{name:22s} {profile(df._jdf.queryExecution().executedPlan().toString())}")


if __name__ == "__main__":
    main()
