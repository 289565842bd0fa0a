"""Distinct users of any period from stored days.

Every user has a number. A day keeps, for each cohort, the set of its users' numbers as bitmaps
of 32768 bits, and the events they made. The users of a week or a month are the union of its
days, so its events are not read and grouped by user again, and the count stays exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, in_interval
from tidemark.functions.numbers import sum_long

#: Users are numbered within so many slots at once; a slot is a hash of the user.
SLOTS = 4096


def _slot(user: str) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(SLOTS))


def new_user_numbers(known: DataFrame, users: DataFrame) -> DataFrame:
    """(user_id, number) of the users that `known` lacks. Numbers start at 1 and never change.

    The next numbers of a slot go to its new users in the order of their ids, so a repeated run
    gives the same ones. Slots fill evenly, which keeps the bitmaps dense.
    """
    fresh = (
        users.select("user_id").filter("user_id IS NOT NULL").distinct()
        .join(known.select("user_id"), "user_id", "left_anti")
        .withColumn("_slot", _slot("user_id"))
    )
    taken = known.groupBy(F.pmod(F.col("number") - 1, F.lit(SLOTS)).alias("_slot")).agg(
        F.count(F.lit(1)).alias("_taken")
    )
    place = F.row_number().over(Window.partitionBy("_slot").orderBy("user_id")) - 1
    return (
        fresh.withColumn("_place", place)
        .join(taken, "_slot", "left")
        .select(
            "user_id",
            ((F.coalesce("_taken", F.lit(0)) + F.col("_place")) * SLOTS + F.col("_slot") + 1)
            .cast("bigint")
            .alias("number"),
        )
    )


def daily_user_bitmaps(
    events: DataFrame,
    cohorts: DataFrame,
    numbers: DataFrame,
    iv: Interval,
    time_col: str = "created_at",
) -> DataFrame:
    """(report_date, cohort_week, bucket, users, event_count) of each day of an interval.

    Events without a user, or of one without a cohort, do not count. They are counted per day
    and user before the joins, so a very active user is one row there.
    """
    per_user = (
        events.filter(in_interval(time_col, iv) & F.col("user_id").isNotNull())
        .groupBy(F.col(time_col).cast("date").alias("report_date"), "user_id")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    dimension = cohorts.select("user_id", "cohort_week").join(
        numbers.select("user_id", "number"), "user_id"
    )
    return (
        per_user.join(dimension, "user_id")
        .groupBy("report_date", "cohort_week", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"),
            sum_long("_n").alias("event_count"),
        )
    )


def users_of_periods(bitmaps: DataFrame, ends: list[str], days: int = 7) -> DataFrame:
    """(period_end, cohort_week, event_count, unique_users) of the `days` days before each end.

    Each stored day goes to the periods that contain it; their bitmaps are united per bucket.
    """
    day = F.col("report_date")
    wanted = [F.lit(e).cast("date") for e in ends]
    placed = bitmaps.withColumn(
        "period_end",
        F.explode(
            F.filter(F.array(*wanted), lambda e: (day < e) & (day >= F.date_sub(e, days)))
        ),
    )
    return (
        placed.groupBy("period_end", "cohort_week", "bucket")
        .agg(F.bitmap_or_agg("users").alias("users"), sum_long("event_count").alias("event_count"))
        .groupBy("period_end", "cohort_week")
        .agg(
            sum_long("event_count").alias("event_count"),
            sum_long(F.bitmap_count("users")).alias("unique_users"),
        )
    )
