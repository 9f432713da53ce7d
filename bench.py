"""Timings of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gaugemill.plans.registry import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "minute_avg_nodes",
    "minute_avg_scalar",
    "load_closed_minutes",
    "load_flags",
    "append_raw_observations",
    "gen_observations",
    "assemble_observations",
    "count_window_batches",
    "minute_rollup_v1",
    "minute_summary_wide",
    "quarterhour_wide_tz",
    "quarterhour_long_nodes",
    "union_distinct_per_second",
    "star_join_observations",
    "mark_imported",
    "upsert_minutes_nullsafe",
    "pending_json_feed",
    "outbox_route_status",
    "dq_foreign_key",
    "stream_minute_avg",
    "late_merge_exact",
]


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def timed(spark: SparkSession, name: str) -> float:
    """Best of a few complete runs, planning included."""
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return best


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    seconds = {name: round(timed(spark, name), 3) for name in HEADLINE}
    per_second = {
        name: round(events / seconds[name])
        for name in ("minute_avg_nodes", "load_closed_minutes", "quarterhour_long_nodes",
                     "gen_observations", "append_raw_observations")
    }
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": per_second,
        "events": events,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
