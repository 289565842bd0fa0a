"""Rollups that follow the changes of the landing instead of the clock.

Every landing write notes its hours in a log of changes, once before it begins and once when it
is done: the first note makes sure that a write which dies halfway is looked at again, the
second that what it wrote last is seen. The rollup reads the hours whose last change is later
than their mark, replaces their counts in the days they lie in, computes the shares of those
days from the hourly counts, and sets the marks last. No other day is written. A run that fails is repeated from the same marks.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, spine
from tidemark.layout import DAILY
from tidemark.operators import changes
from tidemark.plans import batch
from tidemark.plans.lake import Lake
from tidemark.schemas import CHANGE_MARKS, CHANGES, HOURLY_COUNTS
from tidemark.sinks import tables
from tidemark.sources.landing import read_hours

#: Hours that one round reads and replaces.
ROUND = 24 * 31
HOURS_TABLE, SHARES_TABLE = "hourly_event_counts", "daily_event_shares"


def extract_noted(source: DataFrame, lake: Lake, iv: Interval) -> None:
    """Land an interval and note that its hours have changed."""
    note_changes(source.sparkSession, lake, iv)
    batch.extract(source, lake, iv)
    note_changes(source.sparkSession, lake, iv)


def note_changes(spark: SparkSession, lake: Lake, iv: Interval) -> None:
    hours = spine(spark, iv, "1 hour", "hour_start")
    # One moment for all hours, taken when the note is written.
    now = F.lit(datetime.now().astimezone())
    tables.append_log(changes.changes_of(hours, now).coalesce(1), lake.log("landing_changes"))


def rollup_changed_hours(spark: SparkSession, lake: Lake) -> int:
    """Bring the hourly counts and the daily shares up to date; the number of hours done."""
    log = tables.read_or_empty(spark, lake.log("landing_changes"), CHANGES)
    marks = tables.read_or_empty(spark, lake.table("hourly_count_marks"), CHANGE_MARKS)
    # One row per changed hour.
    dirty = sorted(
        changes.dirty_hours(log, marks).collect(), key=lambda r: r.hour_start
    )
    for part in _rounds(dirty):
        _roll_up(spark, lake, part)
    return len(dirty)


def _rounds(dirty: list) -> Iterator[list]:
    """The changed hours in portions; the hours of a day stay together."""
    part: list = []
    for row in dirty:
        if len(part) >= ROUND and part[-1].hour_start.date() != row.hour_start.date():
            yield part
            part = []
        part.append(row)
    if part:
        yield part


def _roll_up(spark: SparkSession, lake: Lake, dirty: list) -> None:
    """Count the changed hours, and put them in place of what their days held of them."""
    hours = [r.hour_start for r in dirty]
    days = sorted({h.replace(hour=0) for h in hours})
    touched = F.col("dt").isin([d.date() for d in days])
    table = lake.gold(HOURS_TABLE)
    stored = tables.read_or_empty(spark, table, HOURLY_COUNTS).filter(touched)
    kept = stored.filter(~F.col("hour_start").isin(hours)).drop("dt")
    counts = changes.hourly_event_counts(read_hours(spark, lake.landing, hours))
    tables.replace_buckets(kept.unionByName(counts), table, DAILY, days, "hour_start")
    now = tables.read_or_empty(spark, table, HOURLY_COUNTS).filter(touched)
    shares = changes.daily_shares(now)
    tables.replace_buckets(shares, lake.gold(SHARES_TABLE), DAILY, days, "report_date")
    seen = spark.createDataFrame(dirty, CHANGES).withColumn("dt", F.col("hour_start").cast("date"))
    tables.upsert_table(
        seen.select(*CHANGE_MARKS.names), lake.table("hourly_count_marks"), ("dt", "hour_start"), ("dt",)
    )
