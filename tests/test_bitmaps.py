"""User numbers and stored days, against counts of distinct users."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import bitmaps, reports
from tidemark.plans import reporting
from tidemark.plans.lake import Lake
from tidemark.session import scratch_dir
from tidemark.sinks import tables

DAY = datetime(2024, 1, 8)
COHORTS = "user_id STRING, cohort_week DATE"


def numbered(spark, known, users):
    df = spark.createDataFrame([(u,) for u in users], "user_id STRING")
    return {r.user_id: r.number for r in bitmaps.new_user_numbers(known, df).collect()}


def test_numbers_are_dense_unique_and_kept(spark):
    none = spark.createDataFrame([], schemas.USER_NUMBERS)
    first = numbered(spark, none, [f"u{i}" for i in range(5000)] + ["u1", None])
    assert len(set(first.values())) == len(first) == 5000 and min(first.values()) >= 1
    assert first == numbered(spark, none, [f"u{i}" for i in range(5000)])
    known = spark.createDataFrame(list(first.items()), schemas.USER_NUMBERS)
    more = numbered(spark, known, [f"u{i}" for i in range(4000, 20_000)])
    assert set(more) == {f"u{i}" for i in range(5000, 20_000)}
    assert not set(more.values()) & set(first.values())
    # Slots fill evenly: 20,000 users need little more than 20,000 numbers.
    assert max(more.values()) < 4 * 20_000


def test_days_unite_to_exact_counts(spark):
    users = [f"u{i}" for i in range(300)]
    cohorts = spark.createDataFrame([(u, (DAY - timedelta(days=7 * (i % 3))).date()) for i, u in enumerate(users[:250])], COHORTS)
    numbers = bitmaps.new_user_numbers(spark.createDataFrame([], schemas.USER_NUMBERS), cohorts)
    # Far numbers too: several buckets.
    numbers = numbers.withColumn("number", F.col("number") * 97)
    rows = [(i, None if i % 31 == 0 else users[(i * 7) % 300], DAY + timedelta(hours=i % 401)) for i in range(6000)]
    events = spark.createDataFrame(rows, "id BIGINT, user_id STRING, created_at TIMESTAMP")
    period = ("2024-01-08", "2024-01-26")
    days = bitmaps.daily_user_bitmaps(events, cohorts, numbers, period)
    assert days.select("bucket").distinct().count() > 3
    found = bitmaps.users_of_periods(days, ["2024-01-10", "2024-01-16", "2024-01-15", "2030-01-01"], days=3)
    got = sorted(tuple(r) for r in found.collect())
    want = []
    for end in ("2024-01-10", "2024-01-15", "2024-01-16"):
        inside = events.join(cohorts, "user_id").filter(
            (F.col("created_at") < end) & (F.col("created_at") >= F.date_sub(F.lit(end).cast("date"), 3))
        )
        counted = inside.groupBy("cohort_week").agg(F.count("id"), F.countDistinct("user_id"))
        want += [(datetime.fromisoformat(end).date(), *r) for r in counted.collect()]
    assert got == sorted(want) and len(got) == 9
    assert bitmaps.users_of_periods(days.limit(0), ["2024-01-10"]).isEmpty()


def test_weekly_report_from_days_equals_the_one_from_events(spark):
    lake = Lake(scratch_dir(spark, "bitmap-lake"))
    rows = [
        (i, None if i % 17 == 0 else f"u{i % 23}", "view", None, 1, None, DAY + timedelta(hours=(i * 5) % 168))
        for i in range(500)
    ]
    events = spark.createDataFrame(rows, schemas.EVENTS)
    from tidemark.layout import HOURLY

    tables.replace_interval(events, lake.landing, HOURLY)
    people = [(f"u{i}", f"u{i}@x", datetime(2023, 12, 1 + i), datetime(2024, 1, 2) if i == 3 else None) for i in range(20)]
    users = spark.createDataFrame(people, schemas.USERS)
    users.write.parquet(lake.table("users"))
    for _ in range(2):
        reporting.weekly_cohorts_from_days(spark, lake, "2024-01-15")
    stored = spark.read.parquet(lake.gold("weekly_cohort_metrics"))
    cohorts = reports.user_cohorts(users, "2024-01-15")
    want = reports.weekly_cohort_metrics(events, users, cohorts, "2024-01-15")
    columns = ("cohort_week", "report_week", "event_count", "unique_users")
    assert sorted(tuple(r) for r in stored.select(*columns).collect()) == sorted(tuple(r) for r in want.select(*columns).collect())
    assert spark.read.parquet(lake.log("user_bitmap_days")).count() == 7
    # A day that comes in again replaces its bitmaps; a day without rows loses them.
    late = events.filter(F.col("created_at") >= "2024-01-09")
    tables.replace_interval(late, lake.landing, HOURLY, ("2024-01-08", "2024-01-15"))
    reporting.user_bitmaps(spark, lake, ("2024-01-08", "2024-01-15"))
    reporting.weekly_cohorts_from_days(spark, lake, "2024-01-15")
    want = reports.weekly_cohort_metrics(late, users, cohorts, "2024-01-15")
    stored = spark.read.parquet(lake.gold("weekly_cohort_metrics"))
    assert sorted(tuple(r) for r in stored.select(*columns).collect()) == sorted(tuple(r) for r in want.select(*columns).collect())
