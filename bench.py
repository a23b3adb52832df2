"""Headline timings: prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPS (default 3). Every query is run once to warm up; ``queries`` holds the
median in seconds, building the plan included, with results sent to the no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators import layout, search  # noqa: E402
from tidemark.plans import ENTRIES  # noqa: E402
from tidemark.plans.facts import four_searches, stored  # noqa: E402
from tidemark.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPS = int(os.environ.get("BENCH_REPS", "3"))

# Query -> the table whose rows it is measured against.
QUERIES = {
    "tumble_fee": "events",
    "slide_window": "events",
    "session_window": "events",
    "min_across_partitions": "events",
    "lateness_class": "events",
    "correction_emit": "events",
    "reconcile_window": "events",
    "cart_write_ttl": "events",
    "running_spend": "orders",
    "current_spend": "orders",
    "latest_by_version": "events",
    "late_version_case": "events",
    "latency_tail": "events",
    "hot_key_counts": "lineitem",
    "skew_case": "events",
    "backfill_case": "lineitem",
    "export_csv": "events",
    "append_replay": "events",
    "enrich_rate_asof": "events",
    "join_streams": "events",
    "features": "events",
    "counter_rate": "events",
    "busy_10m": "events",
    "quality_gate": "events",
}


def measure(run) -> tuple[float, float, float]:
    run()
    times = []
    for _ in range(REPS):
        started = time.perf_counter()
        run()
        times.append(time.perf_counter() - started)
    return statistics.median(times), min(times), max(times)


def main() -> None:
    spark = local_session(CPUS, "bench")
    timings: dict[str, tuple[float, float, float]] = {}

    def noop(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    scans = {}
    for kind in ("user", "symbol"):
        table = spark.read.parquet(stored(spark, SF_DIR, kind))
        for name, found in four_searches(table).items():
            # A fresh frame each time: a collected one keeps its finished shuffle and would not scan again.
            timings[f"{name}.{kind}_first"] = measure(lambda t=table, n=name: search.counted(four_searches(t)[n]).collect())
            scans[f"{name}.{kind}_first"] = (layout.scan_metrics(search.counted(found)) or [{}])[0]
    lookup = spark.read.parquet(stored(spark, SF_DIR, "lookup"))
    timings["order.lookup_table"] = measure(lambda: search.counted(search.order_lookup(lookup, 4243)).collect())
    for name in QUERIES:
        timings[name] = measure(lambda n=name: noop(ENTRIES[n].build(spark, SF_DIR)))

    sizes = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in set(QUERIES.values())}
    medians = {n: round(t[0], 4) for n, t in timings.items()}
    print(
        json.dumps(
            {
                "metric": "total_median_query_time",
                "value": round(sum(medians.values()), 3),
                "unit": "sec",
                "queries": medians,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "min_max": {n: [round(t[1], 4), round(t[2], 4)] for n, t in timings.items()},
                "rows_per_sec": {n: round(sizes[t] / medians[n]) for n, t in QUERIES.items()},
                "search_scans": scans,
                "repetitions": REPS,
                "cpus": CPUS,
            }
        )
    )


if __name__ == "__main__":
    main()
