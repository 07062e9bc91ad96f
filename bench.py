"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) names the input, ``BENCH_CPUS`` the local cores. Each query runs
whole into a sink that discards its rows: once to warm up, then ``BENCH_RUNS`` times, of which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from engage.queries.registry import QUERIES
from engage.session import build_session

HEADLINE = [
    "attribution_full",
    "attribution_clean",
    "first_touch",
    "engagement",
    "channel_summary",
    "merge_upsert",
    "merge_upsert_small_source",
    "merge_update_only",
    "merge_by_ip",
    "last_login",
    "activity_status",
    "incremental_load",
    "social_posts",
    "daily_report",
    "daily_report_by_dim",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "engage-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    timings = {}
    for name in names:
        seconds(lambda: QUERIES[name](spark, sf_dir))
        timings[name] = round(statistics.median(seconds(lambda: QUERIES[name](spark, sf_dir)) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
