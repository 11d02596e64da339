"""Summarise the final (post-AQE) physical plan of every registered query.

Usage: ``python tests/plan_report.py [sf_dir] > PLANS.md``.  Each query is
run with ``collect()`` on its own DataFrame so that ``explain`` shows the
adaptive plan as executed; the summary counts shuffles and lists the join
and aggregate operators chosen.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KINDS = ["Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin",
         "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
         "SortAggregate", "ObjectHashAggregate", "Window", "TakeOrderedAndProject",
         "Generate", "ReusedExchange", "Subquery", "TransformWithState",
         "StreamingSymmetricHashJoin", "BatchEvalPython", "ArrowEvalPython"]


def summarise(plan: str) -> dict:
    body = plan.split("\n\n\n")[0]
    if "== Final Plan ==" in body:
        body = body.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    ops = Counter()
    for line in body.splitlines():
        m = re.search(r"([A-Za-z]+)(?: (?:Inner|LeftOuter|RightOuter|FullOuter|LeftAnti|"
                      r"LeftSemi|Cross))?(?: BuildLeft| BuildRight)? \(\d+\)", line)
        if m and m.group(1) in KINDS:
            ops[m.group(1)] += 1
    ops["skew"] = len(re.findall(r"isSkewJoin=true|skew=true", plan))
    ops["final"] = "isFinalPlan=true" in plan
    return ops


def main() -> None:
    from shopstream.session import build_session
    import __spark_entry__ as E
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    print("| query | shuffles | joins | aggregates | other |")
    print("|---|---|---|---|---|")
    for name, fn in sorted(E.queries().items()):
        df = fn(spark, sf)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        s = summarise(buf.getvalue())
        joins = ", ".join(f"{k} x{s[k]}" for k in ("SortMergeJoin", "BroadcastHashJoin",
                                                  "ShuffledHashJoin", "BroadcastNestedLoopJoin",
                                                  "CartesianProduct") if s[k])
        aggs = ", ".join(f"{k} x{s[k]}" for k in ("HashAggregate", "SortAggregate",
                                                 "ObjectHashAggregate") if s[k])
        other = ", ".join(f"{k} x{s[k]}" for k in ("Window", "TakeOrderedAndProject", "Generate",
                                                  "ReusedExchange", "BroadcastExchange",
                                                  "BatchEvalPython", "ArrowEvalPython") if s[k])
        print(f"| {name} | {s['Exchange']} | {joins or '-'} | {aggs or '-'} | {other or '-'} |",
              flush=True)


if __name__ == "__main__":
    main()
