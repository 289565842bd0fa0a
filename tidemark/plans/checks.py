"""Quality and monitoring jobs. Each records its measurement, passed or failed."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, Moment, moment, ts
from tidemark.operators import (
    drift,
    duplicates,
    messages,
    monitoring,
    payloads,
    quality,
    reports,
)
from tidemark.plans.lake import Lake, dates_of
from tidemark.schemas import (
    EVENTS,
    HEALTH_READINGS,
    INGESTION_ERRORS,
    LIVE_METRICS,
    OFFSET_PLAN,
    OFFSETS,
    REPLAY_OFFSETS,
    TASK_RUNS,
)
from tidemark.sinks import exports, storage, tables
from tidemark.sources.files import (
    hour_of,
    list_files,
    newest_directory,
    newest_file,
    read_footer_schema,
    schema_rows,
)
from tidemark.sources.messages import dlq_bounds, read_dlq
from tidemark.sources.offsets import offset_gaps, plan_offsets, reached_offsets
from tidemark.streaming import health
from tidemark.streaming.sinks import stream_id


def null_gate(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    """Quarantine the NULL rows of failing windows; a repeated run adds nothing."""
    bad = quality.null_quarantine(lake.events(spark, iv), iv=iv)
    bad = bad.withColumn("quarantined_at", F.current_timestamp())
    _log_windows(bad, lake.log("dq_quarantine"), ("event_id", "window_start", "reason"), iv)


def duplicate_check(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    copies = duplicates.duplicate_audit(lake.events(spark, iv))
    copies = copies.withColumn("detected_at", F.current_timestamp())
    _log_windows(copies, lake.log("dq_duplicate_audit"), ("event_id", "window_start"), iv)


def _log_windows(rows: DataFrame, path: str, keys: tuple[str, ...], iv: Interval) -> None:
    """Append to a log that is partitioned by the date of its windows."""
    dated = rows.withColumn("window_date", F.col("window_start").cast("date"))
    tables.append_absent(
        dated, path, ("window_date", *keys), ("window_date",), dates_of("window_date", iv)
    )


def distribution_check(
    spark: SparkSession, lake: Lake, as_of: Moment, threshold: float = drift.DRIFT_THRESHOLD_PCT
) -> None:
    """Compare the day before `as_of` with the seven days before it."""
    day = moment(as_of) - timedelta(days=1)
    period = (day - timedelta(days=7), day + timedelta(days=1))
    audit = drift.drift_audit(
        drift.distribution_drift(lake.events(spark, period), day), day, threshold
    ).withColumn("checked_at", F.current_timestamp())
    tables.upsert_small_table(audit, lake.log("dq_distribution_audit"), ("report_date",))


def schema_check(spark: SparkSession, lake: Lake, reference: dict[str, str] | None = None) -> None:
    """Compare the newest file of the newest landing hour with the reference, by default what
    `extract` writes; skipped if there is none. Raw files have `drift.REFERENCE_SCHEMA`."""
    directory = newest_directory(spark, lake.landing)
    newest = newest_file(list_files(spark, directory)) if directory else None
    if newest is None:
        return
    written = {f.name: f.dataType.simpleString() for f in EVENTS.fields}
    expected = spark.createDataFrame(
        list((reference or written).items()), "col_name STRING, data_type STRING"
    )
    found = drift.schema_drift(schema_rows(read_footer_schema(spark, newest)), expected)
    record = drift.schema_drift_record(found, F.current_timestamp())
    tables.append_log(record, lake.log("dq_schema_drift_log"))


def row_count_check(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    counts = quality.row_count_sla(lake.events(spark, iv), iv)
    counts = counts.withColumn("checked_at", F.current_timestamp())
    tables.upsert_small_table(counts, lake.log("batch_sla_log"), ("window_start",))


def error_check(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    errors = lake.read(spark, "ingestion_errors", INGESTION_ERRORS)
    tables.upsert_small_table(
        reports.error_summary(errors, iv=iv),
        lake.log("error_classification_summary"),
        ("window_start", "error_type"),
    )


def _newest_events(spark: SparkSession, lake: Lake) -> DataFrame:
    """Events of the newest landing hour, which holds the newest event."""
    directory = newest_directory(spark, lake.landing)
    hour = hour_of(directory) if directory else None
    if hour is None:
        return spark.createDataFrame([], EVENTS)
    return lake.events(spark, (hour, hour + timedelta(hours=1)))


def freshness_check(spark: SparkSession, lake: Lake, as_of: Moment) -> None:
    gold = lake.gold("")
    files = (
        list_files(spark, gold)
        if storage.exists(spark, gold)
        else spark.createDataFrame([], "path STRING, size BIGINT, modified_at TIMESTAMP")
    )
    record = monitoring.freshness(_newest_events(spark, lake), files, as_of)
    record = record.withColumn("measured_at", ts(as_of))
    tables.append_log(record, lake.log("sla_measurement_log"))


def freshness_report(spark: SparkSession, lake: Lake) -> None:
    """Share of all logged measurements that met the target."""
    log = spark.read.parquet(lake.log("sla_measurement_log"))
    tables.replace_table(monitoring.freshness_compliance(log), lake.gold("freshness_compliance"))


def stream_check(spark: SparkSession, lake: Lake, as_of: Moment) -> None:
    live = lake.read(spark, "live_event_metrics", LIVE_METRICS)
    record = monitoring.stream_health(live, as_of).withColumn("check_time", ts(as_of))
    tables.append_log(record, lake.log("stream_health_log"))


def failure_report(spark: SparkSession, lake: Lake, as_of: Moment) -> None:
    audit = monitoring.failure_audit(lake.read(spark, "task_runs", TASK_RUNS), as_of)
    tables.append_absent(audit, lake.log("pipeline_failure_audit"), ("report_date", "dag_id"))


def latest_failures(spark: SparkSession, lake: Lake, as_of: Moment) -> None:
    """The failed tasks of the last day, newest first, as a CSV report."""
    runs = lake.read(spark, "task_runs", TASK_RUNS)
    exports.export_csv(
        monitoring.recent_failures(runs, as_of), lake.gold("reports/recent_failures")
    )


def lag_check(spark: SparkSession, lake: Lake, as_of: Moment) -> None:
    lag = monitoring.consumer_lag(lake.read(spark, "consumer_offsets", OFFSETS))
    record = lag.select(
        ts(as_of).alias("check_time"),
        F.lit("kafka").alias("component"),
        "status",
        F.to_json(F.struct("consumer_group", "topic", "lag", "reachable")).alias("details"),
    )
    tables.append_log(record, lake.log("cluster_health_log"))


def cluster_check(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    readings = lake.read(spark, "health_readings", HEALTH_READINGS)
    within = readings.filter(
        (F.col("check_time") >= ts(iv[0])) & (F.col("check_time") < ts(iv[1]))
    )
    tables.append_log(monitoring.health_record(within), lake.log("cluster_health_log"))


def uptime_report(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    """Share of an interval's readings in which each component was up."""
    readings = lake.read(spark, "health_readings", HEALTH_READINGS)
    within = readings.filter(
        (F.col("check_time") >= ts(iv[0])) & (F.col("check_time") < ts(iv[1]))
    )
    tables.replace_table(monitoring.component_uptime(within), lake.gold("component_uptime"))


def payload_check(spark: SparkSession, lake: Lake, iv: Interval, keys: tuple[str, ...]) -> None:
    """Missing and unexpected payload keys of an interval."""
    found = drift.payload_key_drift(lake.events(spark, iv), keys)
    tables.append_log(
        found.withColumn("checked_at", F.current_timestamp()), lake.log("dq_payload_key_log")
    )


def payload_path_check(
    spark: SparkSession, lake: Lake, iv: Interval, expected: dict[str, str]
) -> None:
    """Paths of an interval's payloads whose type or presence is not the expected one."""
    types = payloads.payload_types(lake.events(spark, iv))
    found = payloads.payload_path_drift(types, expected)
    tables.append_log(
        found.withColumn("checked_at", F.current_timestamp()), lake.log("dq_payload_path_log")
    )


def stream_state_check(spark: SparkSession, lake: Lake, as_of: Moment) -> None:
    """What the live metrics stream holds open, how far its watermark is, and what it dropped."""
    state = health.window_state(spark, lake.checkpoint("live_metrics"))
    progress = health.read_progress(spark, lake.log("stream_progress"))
    # One row per stream and one of state; the stream of the checkpoint is the one wanted.
    own = stream_id(spark, lake.checkpoint("live_metrics"))
    last = health.latest_progress(progress.filter(F.col("query_id") == own), as_of).first()
    record = health.state_health(state, as_of).withColumns(
        {
            "watermark_delay_s": F.lit(last.watermark_delay_s if last else None).cast("long"),
            "rows_dropped_late": F.lit(last.total_dropped_late if last else None).cast("long"),
            "check_time": ts(as_of),
        }
    )
    tables.append_log(record, lake.log("stream_state_log"))


def replay_dead_letters(
    spark: SparkSession,
    lake: Lake,
    as_of: Moment,
    source: str,
    sink: str,
    source_options: dict[str, str],
    sink_options: dict[str, str],
    max_messages: int | None = None,
) -> None:
    """Classify the dead letters since the last run, log the unrecoverable ones and republish
    the others.

    The read is planned from the stored offsets and the topic's bounds, so that only messages
    since the last run are read; messages that retention removed unread are logged as gaps.
    Both outputs are always written. The log comes first, so a failed republish can be
    repeated without losing or doubling log rows. Then the next offset of every partition is
    stored, and the next run begins there; a run that fails before republishes again.
    """
    progress = lake.table("dlq_replay_offsets")
    done = tables.read_or_empty(spark, progress, REPLAY_OFFSETS)
    # One row per partition of the topic.
    rows = plan_offsets(done, dlq_bounds(spark, source, **source_options), max_messages).collect()
    plan = spark.createDataFrame(rows, OFFSET_PLAN)
    gaps = offset_gaps(plan).withColumn("noticed_at", ts(as_of))
    tables.append_absent(gaps, lake.log("dlq_offset_gap_log"), ("partition", "from_offset", "to_offset"))
    backlog = read_dlq(spark, source, plan=rows, **source_options)
    classified = messages.classify_messages(backlog, as_of=as_of).persist()
    try:
        fixable, unrecoverable = messages.split_valid_dlq(classified)
        logged = messages.unrecoverable_log(unrecoverable)
        tables.append_absent(
            logged, lake.log("dlq_unrecoverable_log"), ("partition", "kafka_offset")
        )
        exports.republish(exports.replayed(fixable), sink, **sink_options)
        tables.upsert_small_table(reached_offsets(plan), progress, ("partition",))
    finally:
        classified.unpersist()
