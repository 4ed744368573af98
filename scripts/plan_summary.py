"""Print the physical-plan shape of the headline queries: exchanges, join
strategies, aggregates, and what reaches the parquet scans.

    python scripts/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

HEADLINE = ["a1_route_hour", "v9_raw_profile", "a15_box_by_condition", "d8_wide_mart"]


def summarize(plan: str) -> dict:
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    count = {k: nodes.count(k) for k in ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
                                          "BroadcastNestedLoopJoin", "HashAggregate", "Window", "Sort")}
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    return {"nodes": {k: v for k, v in count.items() if v}, "pushed": pushed, "read": schemas}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from fleetlake.catalog import QUERIES
    from fleetlake.session import build_session
    spark = build_session("local[8]")
    for name in HEADLINE:
        df = QUERIES[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        s = summarize(buf.getvalue())
        print(f"{name}: {s['nodes']}")
        for p in s["pushed"]:
            print(f"    pushed: {p}")
        for r in s["read"]:
            print(f"    read:   {r}")
    spark.stop()


if __name__ == "__main__":
    main()
