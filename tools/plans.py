"""Scans, shuffles and joins of each query's final plan: ``plans.py SF_DIR [name ...]``."""

from __future__ import annotations

import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans import ENTRIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402

KINDS = {
    "scans": r"FileScan|Scan parquet|Scan csv",
    "shuffles": r"[^d]Exchange (?!SinglePartition)",
    "single": r"[^d]Exchange SinglePartition",
    "reused": r"ReusedExchange",
    "broadcast": r"BroadcastHashJoin|BroadcastNestedLoopJoin",
    "nested": r"BroadcastNestedLoopJoin|CartesianProduct",
    "merge": r"SortMergeJoin",
    "windows": r"[^a-z]Window ",
    "python": r"ArrowEvalPython|MapInPandas|FlatMapGroups|BatchEvalPython",
}


def final_plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def main(argv: list[str]) -> None:
    spark = local_session(8, "plans")
    for name in argv[1:] or list(ENTRIES):
        df = ENTRIES[name].build(spark, argv[0])
        started = time.perf_counter()
        df._jdf.collectToPython()
        seconds = time.perf_counter() - started
        text = final_plan(df)
        found = {k: len(re.findall(p, text)) for k, p in KINDS.items()}
        print(f"{name:24s} {seconds:6.2f}s " + " ".join(f"{k}={v}" for k, v in found.items() if v), flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
