"""Which hours have changed since they were last rolled up, and what follows from an hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.intervals import bucket_start, hour_of
from tidemark.functions.numbers import pct2, per_unit2
from tidemark.operators.reports import MINUTES_PER_HOUR


def changes_of(hours: DataFrame, at: Column) -> DataFrame:
    """(hour_start, changed_at) for a log of changes."""
    return hours.select("hour_start", at.cast("timestamp").alias("changed_at"))


def dirty_hours(changes: DataFrame, marks: DataFrame) -> DataFrame:
    """(hour_start, changed_at) of the hours whose last change is later than their mark.

    A mark says which change of the hour the rollup has seen, so a change that comes while
    an hour is rolled up leaves it dirty.
    """
    last = changes.groupBy("hour_start").agg(F.max("changed_at").alias("changed_at"))
    seen = marks.select("hour_start", F.col("changed_at").alias("_seen"))
    behind = F.col("_seen").isNull() | (F.col("changed_at") > F.col("_seen"))
    return last.join(seen, "hour_start", "left").filter(behind).drop("_seen")


def hourly_event_counts(events: DataFrame, time_col: str = "created_at") -> DataFrame:
    """Events per hour and type, and their mean per minute, always over 60 minutes."""
    return (
        events.groupBy(bucket_start(time_col, "1 hour").alias("hour_start"), "event_type")
        .agg(F.count(F.lit(1)).alias("total_count"))
        .withColumn("avg_per_minute", per_unit2("total_count", MINUTES_PER_HOUR))
    )


def daily_shares(hours: DataFrame) -> DataFrame:
    """Counts per day, hour and type from hourly ones, with the share of the whole day."""
    day = Window.partitionBy("report_date")
    return hours.select(
        F.col("hour_start").cast("date").alias("report_date"),
        hour_of("hour_start").alias("event_hour"),
        "event_type",
        F.col("total_count").alias("event_count"),
    ).withColumn("pct_of_daily", pct2("event_count", F.sum("event_count").over(day)))
