"""Time the headline queries and print one JSON line.

Every query runs once to warm up and then ``BENCH_REPEATS`` times (default 3); the median
counts. Results go to Spark's ``noop`` sink, so every row and column is computed but none is
collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from siltworks.queries import registry
from siltworks.session import build_session

HEADLINE = [
    "daily_summary", "silver_readings", "air_quality_medallion", "event_spread", "weather_silver",
    "weather_daily", "team_silver", "team_rankings", "country_summary", "line_rank",
    "line_rank_by_flag", "cdc_current", "cdc_history", "cdc_state_merge", "cdc_stream_replay",
    "change_landing", "change_counts", "shared_root", "stream_evolve", "batch_customers",
    "partitioned_overwrite", "append_merge", "rescued_parts", "distinct_keys", "dq_duplicates",
    "dq_quarantine", "dq_keys", "dq_volume", "dq_reconcile", "dq_versions", "dq_distribution",
    "monitor_results",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session("siltworks-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    known, seconds = registry(), {}
    for name in HEADLINE:
        times = []
        for _ in range(repeats + 1):
            started = time.perf_counter()
            known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({"metric": "total of headline query medians", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                      "cpus": int(cpus), "repeats": repeats}))
    spark.stop()


if __name__ == "__main__":
    main()
