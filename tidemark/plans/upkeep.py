"""Retention, archiving and compaction jobs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, Moment, moment, ts
from tidemark.operators import clustering, lifecycle
from tidemark.plans.lake import Lake
from tidemark.schemas import LIVE_METRICS, USERS
from tidemark.sinks import exports, storage, tables
from tidemark.sources.files import list_files


def clean_landing(
    spark: SparkSession, lake: Lake, as_of: Moment, days: int = 30, dry_run: bool = True
) -> DataFrame | None:
    """Delete landing files past retention; None if there is no landing zone yet."""
    if not storage.exists(spark, lake.landing):
        return None
    plan = lifecycle.file_retention_plan(list_files(spark, lake.landing), as_of, days)
    return lifecycle.apply_retention(plan, dry_run)


def purge_metrics(spark: SparkSession, lake: Lake, as_of: Moment, days: int = 90) -> DataFrame:
    """Remove old live metrics; returns the counts before and after.

    The table is partitioned by window date. Dates whose rows have all expired
    are dropped as directories; only the dates around the cutoff are rewritten.
    """
    path = lake.table("live_event_metrics")
    live = lake.read(spark, "live_event_metrics", LIVE_METRICS)
    stats = lifecycle.retention_stats(live, "recorded_at", as_of, days)
    result = spark.createDataFrame(stats.collect(), stats.schema)
    if not storage.exists(spark, path):
        return result
    # One row per date.
    stored = spark.read.parquet(path)
    expired = F.col("recorded_at") < ts(moment(as_of) - timedelta(days=days))
    dates = (
        stored.groupBy("window_date")
        .agg(F.count_if(expired).alias("old"), F.count(F.lit(1)).alias("all"))
        .filter("old > 0")
        .select("window_date", (F.col("old") == F.col("all")).alias("whole"))
    )
    partly = dates.filter(~F.col("whole")).select("window_date")
    survivors = lifecycle.retain(
        stored.join(partly, "window_date", "left_semi"), "recorded_at", as_of, days
    )
    whole = [r.window_date for r in dates.filter("whole").select("window_date").collect()]
    tables.replace_partitions(survivors, path, ("window_date",), ("window_start",))
    for date in whole:
        storage.delete(spark, f"{path}/window_date={date.isoformat()}")
    return result


def archive_users(
    spark: SparkSession, lake: Lake, as_of: Moment, days: int = 180, limit: int | None = None
) -> None:
    """Archive inactive users, then soft-delete exactly the archived ones."""
    storage.recover(spark, lake.table("users"))
    users = lake.read(spark, "users", USERS)
    period = (moment(as_of) - timedelta(days=days), moment(as_of) + timedelta(microseconds=1))
    recent = lake.events(spark, period)
    path = lake.gold("archived_users")
    exports.archive(
        lifecycle.inactive_users(users, recent, as_of, days, limit),
        path,
        as_of,
        f"inactive_{days}d",
    )
    if not storage.exists(spark, f"{path}/archive_date={moment(as_of).date().isoformat()}"):
        return
    archived = spark.read.parquet(path).filter(
        F.col("archive_date") == F.lit(moment(as_of).date())
    )
    tables.replace_table(tables.soft_delete(users, archived, ts(as_of)), lake.table("users"))


def compact_bronze(spark: SparkSession, lake: Lake, dates: list[str]) -> None:
    """Compact bronze dates into gold and record the manifest; skipped without bronze."""
    if not storage.exists(spark, lake.bronze):
        return
    manifest = lifecycle.compact(spark, lake.bronze, lake.gold("compacted"), dates)
    tables.upsert_small_table(manifest, lake.log("compaction_manifest"), ("compaction_date",))


def cluster_events(spark: SparkSession, lake: Lake, iv: Interval, files: int) -> None:
    """Events of an interval as files of small ranges of time and users, for `read_users`."""
    clustering.write_clustered(lake.events(spark, iv), lake.gold("events_by_user"), files)
