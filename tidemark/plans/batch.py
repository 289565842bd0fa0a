"""Ingestion, gold aggregation, tenants, backfill and adaptive reprocessing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, Moment, in_interval, moment, ts
from tidemark.layout import DAILY, HOURLY
from tidemark.operators import lifecycle, monitoring, quality, reports, tenants
from tidemark.plans.lake import Lake, trailing, window_label
from tidemark.schemas import BACKFILLED, RUN_LOG, TENANT_GOLD, normalise
from tidemark.sinks import storage, tables
from tidemark.sources.files import list_files, partition_dates
from tidemark.sources.landing import read_landing, tenant_layout

PRODUCT_GOLD = "product_performance_metrics"
TENANT_TABLE = "analytics_tenants"


def extract(source: DataFrame, lake: Lake, iv: Interval) -> None:
    """Land the raw events of an interval; the same interval overwrites itself."""
    events = normalise(source).filter(in_interval("created_at", iv))
    tables.replace_interval(events, lake.landing, HOURLY, iv)


def extract_tenants(source: DataFrame, lake: Lake, iv: Interval | None = None) -> None:
    """Land events that carry a `tenant`, by tenant and day, in the order of their time.

    Without an interval, the days of a tenant that occur are replaced. With one, of whole days,
    the landing holds exactly its events for those days: a tenant that has none there any more
    loses what it had. A landing that is partitioned by hour stays so.
    """
    layout = tenant_layout(source.sparkSession, lake.tenant_landing)
    if iv is not None:
        source = source.filter(in_interval("created_at", iv))
    tables.replace_interval(source, lake.tenant_landing, layout, iv, leading="tenant")


def product_metrics(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    """Conversions per product of one window. Gold keeps every window."""
    counts = reports.product_conversions(lake.events(spark, iv), iv)
    tables.replace_window(
        reports.with_audit_columns(counts, iv), lake.gold(PRODUCT_GOLD), window_label(iv)
    )


def tenant_metrics(spark: SparkSession, lake: Lake, manifest: DataFrame, as_of: Moment) -> None:
    """Conversions of all manifest tenants in one job.

    The manifest is configuration: its tenants and its longest retention prune the scan.
    """
    entries = manifest.select("client_id", "retention_days").collect()
    longest = max((e.retention_days for e in entries), default=0)
    iv = (moment(as_of) - timedelta(days=longest), as_of)
    events = read_landing(
        spark, lake.tenant_landing, iv=iv, tenants=[e.client_id for e in entries]
    )
    gold = tenants.tenant_conversions(events, manifest, as_of)
    gold = gold.withColumn("processed_at", F.current_timestamp())
    tables.replace_table(gold, lake.gold(TENANT_TABLE), ("tenant_id",))


def promote(
    spark: SparkSession, lake: Lake, iv: Interval, allowed: tuple[str, ...] | None = None
) -> None:
    """Validated records of an interval of whole days, from landing to bronze."""
    clean = quality.promote_to_bronze(lake.events(spark, iv), allowed=allowed)
    tables.replace_interval(clean, lake.bronze, DAILY, iv)


def backfill_products(spark: SparkSession, lake: Lake, as_of: Moment, lookback: int = 7) -> None:
    """Recompute the missing days of the look-back period, and only those, in one job."""
    period = trailing(as_of, lookback)
    path = lake.gold("daily_" + PRODUCT_GOLD)
    if storage.exists(spark, path):
        present = partition_dates(list_files(spark, path))
    else:
        present = spark.createDataFrame([], "dt DATE")
    # A day without purchases leaves no file; the log has those that were found empty.
    log = lake.log("empty_days")
    empty = tables.read_or_empty(spark, log, BACKFILLED)
    missing = lifecycle.missing_partitions(present.union(empty), as_of, lookback)
    # At most `lookback` rows; fixed before the files of these days appear.
    missing = spark.createDataFrame(missing.collect(), BACKFILLED)
    filled = lifecycle.backfill(
        lake.events(spark, period),
        missing,
        lambda df: reports.product_conversions(df, period, every="1 day"),
        as_of,
        lookback,
    )
    tables.replace_interval(filled, path, DAILY, time_col="window_start")
    found = partition_dates(list_files(spark, path)) if storage.exists(spark, path) else present
    tables.append_absent(missing.join(found, "dt", "left_anti"), log, ("dt",))


def adaptive_run(spark: SparkSession, lake: Lake, iv: Interval, pipeline: str = "etl") -> None:
    """Process the run's interval, or the whole previous day after a series of low runs.

    The decision is one row of run history, read to choose the job's parameters.
    """
    log = lake.read(spark, "pipeline_run_log", RUN_LOG)
    history = log.filter((F.col("pipeline") == pipeline) & (F.col("interval_start") < ts(iv[0])))
    plan = monitoring.adaptive_interval(monitoring.adaptive_mode(history), iv).first()
    chosen = (plan.start, plan.end) if plan else iv
    mode = plan.mode if plan else "incremental"
    product_metrics(spark, lake, chosen)
    counts = quality.row_count_sla(lake.events(spark, iv), iv)
    record = monitoring.run_record(counts, pipeline, F.lit(mode), F.current_timestamp())
    tables.upsert_small_table(
        record, lake.table("pipeline_run_log"), ("pipeline", "interval_start")
    )


def batch_tenant(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    """Batch and tenant gold side by side for one window."""
    batch = spark.read.parquet(lake.gold(PRODUCT_GOLD)).filter(
        (F.col("window_start") == ts(iv[0])) & (F.col("window_end") == ts(iv[1]))
    )
    tenant = tables.read_or_empty(spark, lake.gold(TENANT_TABLE), TENANT_GOLD)
    joined = tenants.batch_tenant_join(batch, tenant)
    tables.replace_window(joined, lake.gold("batch_tenant_comparison"), window_label(iv))

