"""Seconds per headline query; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8),
BENCH_QUERIES (comma separated keys, or "all").
Each query runs once to warm up and is then timed over a full scan of its result.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.queries import queries

HEADLINE = [
    "parse_events",
    "validate_events",
    "batch_receipt",
    "dedup_events",
    "fact_events",
    "activity_rollup",
    "dim_users",
    "session_engagement",
    "engagement_metrics",
    "retention_comparison",
    "funnel_rates",
    "funnel_long",
    "session_metrics",
    "realtime_metrics",
    "stream_funnel",
    "active_users_5m",
    "sessionize",
    "derive_step_timing",
    "recommendation_scores",
    "ingest_latency_p95",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("eventlift-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries()
    names = list(registry) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE

    seconds = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
