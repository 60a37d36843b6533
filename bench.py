"""Time the headline queries; prints one JSON line.

Reads BENCH_SF_DIR (default the sf0.1 tables) on local[BENCH_CPUS]. Every query runs
its whole plan into a sink that discards the rows; the time is the median of the
warm runs (BENCH_RUNS, default 3) after one that is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadspan.plans import catalog  # noqa: E402
from roadspan.session import local_session  # noqa: E402

HEADLINE = [
    "date_dim",
    "trace_with_prev",
    "vehicle_daily_performance",
    "alert_fact",
    "distance_by_month",
    "distance_by_day_live",
    "speed_by_day",
    "alerts_type1_by_month",
    "journey_segments",
    "journey_speed_stats",
    "journey_dim",
    "filter_large_jumps",
    "state_traveled_distance",
    "state_avg_speed",
    "rolling_sensor_stats",
    "latest_row_per_vehicle",
    "place_lookup",
    "training_projection",
    "linear_fit",
    "order_wide_table",
    "vehicle_state_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = sys.argv[1:]
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = catalog.queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        if only and name not in only:
            continue
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of warm medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "rows_per_sec": {
                    "vehicle_state_stream": round(
                        spark.read.parquet(f"{sf_dir}/events.parquet").count()
                        / seconds["vehicle_state_stream"]
                    )
                }
                if "vehicle_state_stream" in seconds
                else {},
            }
        )
    )


if __name__ == "__main__":
    main()
