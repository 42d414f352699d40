"""Audit the physical plan of every registered query: shuffles, broadcasts,
nested-loop / cartesian joins, windows, Python evaluation, pushed filters.

usage: python tools/plan_audit.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.registry import load_all  # noqa: E402
from tessera.session import build_session  # noqa: E402

COUNTERS = {
    "shuffles": r"^\(\d+\) Exchange",
    "broadcasts": r"^\(\d+\) BroadcastExchange",
    "bnl_joins": r"^\(\d+\) BroadcastNestedLoopJoin",
    "cartesian": r"^\(\d+\) CartesianProduct",
    "smj": r"^\(\d+\) SortMergeJoin",
    "bhj": r"^\(\d+\) BroadcastHashJoin",
    "windows": r"^\(\d+\) Window",
    "python": r"^\(\d+\) (ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas)",
    "scans": r"^\(\d+\) Scan ",
    "pushed_filter_scans": r"^PushedFilters: \[.+\]",
}


def main():
    args = sys.argv[1:]
    sf = args[0] if args else "/root/testdata/sf0.01"
    reg = load_all()
    spark = build_session("local[8]", 8)
    print("# Physical plan audit\n")
    print(f"Initial (pre-AQE) physical plans at `{sf}`; AQE may still turn shuffle joins into broadcasts at runtime.\n")
    print("| query | " + " | ".join(COUNTERS) + " |")
    print("|---|" + "---|" * len(COUNTERS))
    for k in sorted(reg):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            reg[k][0](spark, sf).explain("formatted")
        text = buf.getvalue()
        counts = [len(re.findall(p, text, flags=re.M)) for p in COUNTERS.values()]
        print(f"| {k} | " + " | ".join(str(c) for c in counts) + " |", flush=True)


if __name__ == "__main__":
    main()
