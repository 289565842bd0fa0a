"""Freshness, run history, failures, consumer lag and component health."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, Moment, day, moment, ts
from tidemark.functions.numbers import pct2, sum_long

SLA_TARGET_SECONDS = 7200
NO_DATA_SECONDS = 999_999
NO_DATA_HOURS = 999.0
STREAM_MAX_HOURS = 2
LOW_RUNS = 3
LOW_ROWS = 10
ESCALATION_FAILURES = 5
LAG_THRESHOLD = 5000
MIN_WORKERS = 1


def _micros_since(latest: Column, as_of: Moment) -> Column:
    return F.unix_micros(ts(as_of)) - F.unix_micros(latest)


def _lag_seconds(latest: Column, as_of: Moment) -> Column:
    whole = F.call_function("div", _micros_since(latest, as_of), F.lit(1_000_000).cast("bigint"))
    return F.coalesce(whole, F.lit(NO_DATA_SECONDS).cast("bigint"))


def freshness(
    source: DataFrame,
    gold_files: DataFrame,
    as_of: Moment,
    target_s: int = SLA_TARGET_SECONDS,
    source_time: str = "created_at",
    gold_time: str = "modified_at",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Seconds since the newest event and the newest gold file, and the SLA decision.

    The end-to-end lag is the greater of the two; an empty side counts as
    NO_DATA_SECONDS. Both sides feed one aggregation. `by` measures per group.
    """
    nothing = F.lit(None).cast("timestamp")
    newest = (
        source.select(*by, F.col(source_time).alias("_source"), nothing.alias("_gold"))
        .unionByName(
            gold_files.select(*by, nothing.alias("_source"), F.col(gold_time).alias("_gold"))
        )
        .groupBy(*by)
        .agg(F.max("_source").alias("_source"), F.max("_gold").alias("_gold"))
    )
    return (
        newest.select(
            *by,
            _lag_seconds(F.col("_source"), as_of).alias("source_lag_seconds"),
            _lag_seconds(F.col("_gold"), as_of).alias("gold_lag_seconds"),
        )
        .withColumn(
            "e2e_lag_seconds", F.greatest("source_lag_seconds", "gold_lag_seconds")
        )
        .withColumns(
            {
                "sla_met": F.col("e2e_lag_seconds") <= target_s,
                "sla_target_seconds": F.lit(target_s).cast("bigint"),
            }
        )
    )


def freshness_compliance(log: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Share of measurements that met the SLA."""
    return (
        log.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("measurements"),
            F.count_if("sla_met").alias("met"),
        )
        .withColumn("compliance_pct", pct2("met", "measurements"))
    )


def stream_health(
    metrics: DataFrame,
    as_of: Moment,
    max_hours: float = STREAM_MAX_HOURS,
    time_col: str = "recorded_at",
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Hours since the newest stream output; NO_DATA_HOURS if there is none."""
    return (
        metrics.groupBy(*by)
        .agg(F.max(time_col).alias("_latest"))
        .select(
            *by,
            F.coalesce(
                _micros_since(F.col("_latest"), as_of) / F.lit(3_600_000_000.0),
                F.lit(NO_DATA_HOURS),
            ).alias("lag_hours"),
        )
        .withColumn("healthy", F.col("lag_hours") <= max_hours)
    )


def adaptive_mode(
    run_log: DataFrame,
    n: int = LOW_RUNS,
    min_rows: int = LOW_ROWS,
    by: tuple[str, ...] = ("pipeline",),
    time_col: str = "interval_start",
) -> DataFrame:
    """Full reprocessing if each of the last `n` runs of a pipeline was low on rows.

    Fewer than `n` runs mean incremental. Only the newest `n` rows per pipeline
    leave each map task.
    """
    newest = Window.partitionBy(*by).orderBy(F.desc(time_col))
    return (
        run_log.select(*by, time_col, "row_count")
        .withColumn("_rn", F.row_number().over(newest))
        .filter(F.col("_rn") <= n)
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("runs_seen"),
            F.coalesce(F.bool_and(F.col("row_count") < min_rows), F.lit(False)).alias("_low"),
        )
        .withColumn("needs_full_reprocess", (F.col("runs_seen") == n) & F.col("_low"))
        .withColumn(
            "mode", F.when(F.col("needs_full_reprocess"), "full").otherwise("incremental")
        )
        .drop("_low")
    )


def adaptive_interval(decisions: DataFrame, iv: Interval) -> DataFrame:
    """Interval to process: the whole day before the run date, or the run's own interval."""
    run_date = moment(iv[0]).replace(hour=0, minute=0, second=0, microsecond=0)
    full = F.col("mode") == "full"
    return decisions.withColumns(
        {
            "start": F.when(full, ts(run_date - timedelta(days=1))).otherwise(ts(iv[0])),
            "end": F.when(full, ts(run_date)).otherwise(ts(iv[1])),
        }
    )


def run_record(
    row_counts: DataFrame, pipeline: str, mode: Column, passed_at: Column
) -> DataFrame:
    """Run-log rows from (window_start, row_count), keyed by pipeline and interval."""
    return row_counts.select(
        F.lit(pipeline).alias("pipeline"),
        F.col("window_start").alias("interval_start"),
        "row_count",
        mode.alias("mode"),
        passed_at.alias("passed_at"),
    )


def _failed_since(task_runs: DataFrame, as_of: Moment, hours: int) -> DataFrame:
    start = moment(as_of) - timedelta(hours=hours)
    return task_runs.filter(
        (F.col("state") == "failed")
        & (F.col("start_date") >= ts(start))
        & (F.col("start_date") <= ts(as_of))
    )


def failure_audit(
    task_runs: DataFrame, as_of: Moment, hours: int = 24, threshold: int = ESCALATION_FAILURES
) -> DataFrame:
    """Final failures per pipeline with their tasks, first and last time, and escalation.

    Failures are counted per task before they are gathered per pipeline, so the
    list holds one entry per task and not one per failure. The audit escalates as
    soon as any pipeline has more than `threshold` failures.
    """
    whole = Window.partitionBy()
    worst = Window.partitionBy().orderBy(F.desc("failure_count"), F.desc("last_failure"), "dag_id")
    return (
        _failed_since(task_runs, as_of, hours)
        .groupBy("dag_id", "task_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("start_date").alias("_first"),
            F.max("start_date").alias("_last"),
        )
        .groupBy("dag_id")
        .agg(
            F.array_join(F.array_sort(F.collect_list("task_id")), ", ").alias("task_ids"),
            sum_long("_n").alias("failure_count"),
            F.min("_first").alias("first_failure"),
            F.max("_last").alias("last_failure"),
        )
        .select(
            day(as_of).alias("report_date"),
            "dag_id",
            "task_ids",
            "failure_count",
            "first_failure",
            "last_failure",
            (F.row_number().over(worst) == 1).alias("is_worst"),
            (F.max("failure_count").over(whole) > threshold).alias("escalate"),
        )
    )


def recent_failures(
    task_runs: DataFrame, as_of: Moment, n: int = 1000, hours: int = 24
) -> DataFrame:
    """The newest `n` failures, in a total order."""
    return (
        _failed_since(task_runs, as_of, hours)
        .select("dag_id", "task_id", "state", "start_date", "try_number")
        .orderBy(F.desc("start_date"), "dag_id", "task_id", "try_number")
        .limit(n)
    )


def consumer_lag(
    offsets: DataFrame, threshold: int = LAG_THRESHOLD, groups: DataFrame | None = None
) -> DataFrame:
    """Lag per consumer group and topic, summed over partitions.

    A group without any committed offset is unreachable, with a lag of -1; so is
    a group of `groups` that has no row at all. A lag of 0 stays 0.
    """
    keys = ["consumer_group", "topic"]
    lag = offsets.groupBy(*keys).agg(
        sum_long(F.col("end_offset") - F.col("committed_offset")).alias("lag")
    )
    if groups is not None:
        lag = groups.select(*keys).distinct().join(lag, keys, "left")
    reachable = F.col("lag").isNotNull()
    return lag.select(
        *keys,
        F.coalesce("lag", F.lit(-1).cast("bigint")).alias("lag"),
        reachable.alias("reachable"),
        F.when(~reachable, "unreachable")
        .when(F.col("lag") > threshold, "high")
        .otherwise("ok")
        .alias("level"),
        F.when(reachable & (F.col("lag") <= threshold), "ok").otherwise("degraded").alias("status"),
    )


def component_status(readings: DataFrame, min_workers: int = MIN_WORKERS) -> DataFrame:
    """Reading with its state: unreachable, degraded (too few workers) or ok."""
    reachable = F.coalesce("reachable", F.lit(False))
    enough = F.coalesce(F.col("alive_workers") >= min_workers, F.lit(False))
    return readings.withColumn(
        "status",
        F.when(~reachable, "unreachable").when(~enough, "degraded").otherwise("ok"),
    )


def component_uptime(readings: DataFrame, min_workers: int = MIN_WORKERS) -> DataFrame:
    """Share of ok readings per component and day."""
    return (
        component_status(readings, min_workers)
        .groupBy("component", F.col("check_time").cast("date").alias("check_date"))
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.count_if(F.col("status") == "ok").alias("ok_readings"),
            F.count_if(F.col("status") == "unreachable").alias("unreachable_readings"),
        )
        .withColumn("uptime_pct", pct2("ok_readings", "readings"))
    )


def health_record(readings: DataFrame, min_workers: int = MIN_WORKERS) -> DataFrame:
    """Health-log rows with the reading itself as JSON."""
    return component_status(readings, min_workers).select(
        "check_time",
        "component",
        F.when(F.col("status") == "ok", "ok").otherwise("degraded").alias("status"),
        F.to_json(F.struct("reachable", "alive_workers")).alias("details"),
    )
