"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "flow_hits",
    "file_detection_summary",
    "rolling_window_alerts",
    "fixed_window_alerts",
    "window_statistics",
    "alert_targets",
    "whitelist_antijoin",
    "alert_intake",
    "block_actions",
    "block_episodes",
    "block_history",
    "block_counters",
    "aligned_features",
    "clean_features",
    "scaler_fit",
    "stratified_split",
    "roc_auc",
    "session_flows",
    "packet_flows",
    "iat_stats",
    "minority_neighbours",
    "smote_counts",
    "forest_scores",
    "alert_roundtrip",
    "stream_rolling_alerts",
    "stream_blocks",
    "stream_model_scores",
    "stream_retry",
    "whitelist_long",
    "state_many_batches",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:]
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from flowwarden.bindings import QUERIES

    flows = spark.read.parquet(f"{sf_dir}/events.parquet").count()  # also warms the session up
    seconds = {}
    for name in names or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    window = seconds.get("rolling_window_alerts")
    forest = seconds.get("stream_model_scores")  # with the fit of the forest, saved, loaded and scoring a stream
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "flows": flows,
                "flows_per_second_to_alerts": round(flows / window) if window else None,
                "flows_per_second_with_forest": round(flows / forest) if forest else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
