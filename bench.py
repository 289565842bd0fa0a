"""Wall time of the named queries. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import build_session, drop_scratch  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

# Queries that write tables or run a stream: one timed run after the warm-up.
HEAVY = {
    "archived_users",
    "bronze_promoted",
    "cohort_users_from_bitmaps",
    "compaction_manifest",
    "compaction_result",
    "csv_export",
    "dlq_bounded_batch",
    "dlq_offset_ranges",
    "dlq_replay_twice",
    "duplicate_audit",
    "duplicate_rank",
    "file_retention_plan",
    "insert_if_absent_result",
    "interval_reload_result",
    "landing_roundtrip",
    "measurement_log",
    "payload_path_drift",
    "pruned_user_interval",
    "republished_messages",
    "rollup_after_late_hours",
    "rows_out_of_order",
    "stream_counts_and_late_rows",
    "stream_deduplicated_minutes",
    "stream_late_rows",
    "stream_minute_counts",
    "stream_state_health",
    "stream_valid_dlq_split",
    "stream_without_late_rows",
    "tenant_conversions_by_manifest_file",
    "tenant_gold_report",
    "tenant_landing_roundtrip",
    "tenant_reload_result",
    "upsert_result",
    "windowed_gold",
}


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or sorted(QUERIES)
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in only:
        runs = 1 if name in HEAVY else 3
        timed(spark, name, sf_dir)
        seconds[name] = round(
            statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3
        )
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "event_rows": rows,
    }
    if "stream_minute_counts" in seconds:
        result["stream_rows_per_sec"] = round(rows / seconds["stream_minute_counts"])
    print(json.dumps(result))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
