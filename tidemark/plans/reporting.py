"""Report jobs: idempotent upserts into gold tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import (
    Interval,
    Moment,
    month_interval,
    previous_month,
    require_whole,
    spine,
    week_start,
)
from tidemark.layout import DAILY
from tidemark.operators import bitmaps, reports, tenants
from tidemark.plans.batch import TENANT_TABLE
from tidemark.plans.lake import Lake, dates_of, trailing
from tidemark.schemas import LIVE_METRICS, STORED_DAYS, USER_NUMBERS, USERS
from tidemark.sinks import exports, tables
from tidemark.sources.landing import read_tenant_gold


def daily_summary(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    """Replace the report days of an interval of whole days."""
    require_whole(iv, "1 day")
    summary = reports.daily_event_summary(lake.events(spark, iv), iv)
    tables.replace_partitions(
        summary, lake.gold("daily_event_summary"), ("report_date",), ("event_hour", "event_type")
    )


def hourly_rollup(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    """Roll up the minute windows of an interval; hours without rows are not written."""
    require_whole(iv, "1 hour")
    live = lake.read(spark, "live_event_metrics", LIVE_METRICS).filter(
        dates_of("window_date", iv)
    )
    rollup = reports.hourly_rollup(live, iv).withColumn("dt", F.col("hour_start").cast("date"))
    tables.upsert_table(
        rollup,
        lake.gold("hourly_metrics_rollup"),
        ("dt", "hour_start", "event_type"),
        ("dt",),
        scope=dates_of("dt", iv),
    )


def weekly_cohorts(spark: SparkSession, lake: Lake, as_of: Moment) -> None:
    """Add new users to the cohort dimension, then report the week and export it."""
    users = lake.read(spark, "users", USERS)
    dimension = lake.gold("user_cohorts")
    tables.append_absent(reports.user_cohorts(users, as_of), dimension, ("user_id",))
    week = trailing(as_of, 7)
    metrics = reports.weekly_cohort_metrics(
        lake.events(spark, week), users, spark.read.parquet(dimension), as_of
    )
    path = lake.gold("weekly_cohort_metrics")
    tables.upsert_small_table(metrics, path, ("cohort_week", "report_week"))
    stored = spark.read.parquet(path)
    label = week[1].date().isoformat()
    exports.export_csv(stored, lake.gold(f"reports/weekly_cohorts_{label}"))


def user_bitmaps(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    """Store the users of each day of an interval of whole days, as bitmaps by cohort."""
    require_whole(iv, "1 day")
    cohorts = spark.read.parquet(lake.gold("user_cohorts"))
    path = lake.table("user_numbers")
    numbers = tables.read_or_empty(spark, path, USER_NUMBERS)
    tables.append_log(bitmaps.new_user_numbers(numbers, cohorts), path)
    numbers = tables.read_or_empty(spark, path, USER_NUMBERS)
    days = bitmaps.daily_user_bitmaps(lake.events(spark, iv), cohorts, numbers, iv)
    tables.replace_interval(days, lake.gold("user_bitmaps"), DAILY, iv, "report_date")
    done = spine(spark, iv, "1 day", "at").select(F.col("at").cast("date").alias("report_date"))
    tables.append_absent(done, lake.log("user_bitmap_days"), ("report_date",))


def weekly_cohorts_from_days(spark: SparkSession, lake: Lake, as_of: Moment) -> None:
    """The week's users and events per cohort as the union of its stored days.

    Days that are not stored yet are stored first; only their events are read.
    """
    users = lake.read(spark, "users", USERS)
    dimension = lake.gold("user_cohorts")
    tables.append_absent(reports.user_cohorts(users, as_of), dimension, ("user_id",))
    start, end = trailing(as_of, 7)
    stored = tables.read_or_empty(spark, lake.log("user_bitmap_days"), STORED_DAYS)
    # At most the seven days of the week.
    known = {r.report_date for r in stored.filter(dates_of("report_date", (start, end))).collect()}
    for day in (start + timedelta(days=i) for i in range(7)):
        if day.date() not in known:
            user_bitmaps(spark, lake, (day, day + timedelta(days=1)))
    week = spark.read.parquet(lake.gold("user_bitmaps")).filter(dates_of("dt", (start, end)))
    report = bitmaps.users_of_periods(week, [end.date().isoformat()]).select(
        "cohort_week", week_start(F.col("period_end")).alias("report_week"),
        "event_count", "unique_users",
    )
    tables.upsert_small_table(
        report, lake.gold("weekly_cohort_metrics"), ("cohort_week", "report_week")
    )


def monthly_kpis(spark: SparkSession, lake: Lake, as_of: Moment) -> DataFrame:
    """Store the KPIs of the month before `as_of`; returns them with the zero warning."""
    month = previous_month(as_of)
    before = previous_month(month_interval(month)[0])
    period = (month_interval(before)[0], month_interval(month)[1])
    kpis = reports.monthly_kpis(lake.events(spark, period), [before, month]).filter(
        F.col("report_month") == month
    )
    tables.upsert_small_table(
        reports.storable_kpis(kpis), lake.gold("monthly_kpi_report"), ("report_month",)
    )
    return kpis


def cross_tenant(
    spark: SparkSession, lake: Lake, manifest: DataFrame, report_week: Moment
) -> None:
    gold = read_tenant_gold(spark, lake.gold(TENANT_TABLE), manifest)
    tables.upsert_small_table(
        tenants.cross_tenant_comparison(gold, manifest, report_week),
        lake.gold("cross_tenant_comparison"),
        ("report_week",),
    )
