"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed to completion through the ``noop`` sink (the whole
plan runs, nothing is shipped to Python), once to warm up and then
$BENCH_REPS times; the median is reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from clickmart.plans.queries import REGISTRY  # noqa: E402
from clickmart.session import build_session  # noqa: E402

HEADLINE = [
    "stage_purchases",
    "mart_events_distribution_hourly",
    "mart_users_segments",
    "explore_wide_events",
    "report_events_pivot",
    "mart_campaign_purchases_hourly",
    "stage_conversion",
    "explore_ip_sessions",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in REGISTRY]
    spark = build_session(f"local[{cpus}]", app="clickmart-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "2g")})
    timings = {}
    for name in names:
        run_once(spark, name, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(reps)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf_val,
        "cpus": cpus,
        "reps": reps,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
