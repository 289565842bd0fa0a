"""Product, daily, hourly, weekly and monthly reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.intervals import (
    Interval,
    Moment,
    bucket_start,
    day,
    hour_of,
    in_interval,
    month_interval,
    month_start,
    ts,
    week_start,
)
from tidemark.functions.numbers import (
    WIDE_AMOUNT,
    mean2,
    pct2,
    per_unit2,
    safe_amount,
    sum_long,
)

MINUTES_PER_HOUR = 60


def product_conversions(
    events: DataFrame,
    iv: Interval,
    event_type: str = "purchase",
    every: str | None = None,
    time_col: str = "created_at",
) -> DataFrame:
    """Conversions per product; a NULL product is a group of its own.

    With `every`, counts are per bucket as well, so that one job fills any number
    of reporting windows.
    """
    keys = [F.col("product_id")]
    if every is not None:
        keys.insert(0, bucket_start(time_col, every).alias("window_start"))
    return (
        events.filter(in_interval(time_col, iv))
        .filter(F.col("event_type") == event_type)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total_conversions"))
    )


def with_audit_columns(df: DataFrame, iv: Interval) -> DataFrame:
    """Window bounds and processing time for gold rows."""
    return df.withColumns(
        {
            "window_start": ts(iv[0]),
            "window_end": ts(iv[1]),
            "processed_at": F.current_timestamp(),
        }
    )


def daily_event_summary(
    events: DataFrame, iv: Interval, time_col: str = "created_at"
) -> DataFrame:
    """Counts per day, hour and type, with the share of the whole day.

    The share is a window over the aggregate, partitioned by day.
    """
    whole_day = Window.partitionBy("report_date")
    return (
        events.filter(in_interval(time_col, iv))
        .groupBy(
            F.col(time_col).cast("date").alias("report_date"),
            hour_of(time_col).alias("event_hour"),
            "event_type",
        )
        .agg(F.count(F.lit(1)).alias("event_count"))
        .withColumn("pct_of_daily", pct2("event_count", F.sum("event_count").over(whole_day)))
    )


def hourly_rollup(minute_metrics: DataFrame, iv: Interval) -> DataFrame:
    """Hourly totals of minute windows and the mean per minute, always over 60 minutes.

    A window that was emitted several times counts once, with its latest value.
    """
    latest = minute_metrics.filter(in_interval("window_start", iv)).groupBy(
        "window_start", "event_type"
    )
    if "recorded_at" in minute_metrics.columns:
        newest = F.max(F.struct("recorded_at", "event_count"))["event_count"]
    else:
        newest = F.max("event_count")
    return (
        latest.agg(newest.alias("event_count"))
        .groupBy(bucket_start("window_start", "1 hour").alias("hour_start"), "event_type")
        .agg(sum_long("event_count").alias("total_count"))
        .withColumn("avg_per_minute", per_unit2("total_count", MINUTES_PER_HOUR))
    )


def active_users(users: DataFrame, as_of: Moment) -> DataFrame:
    """Users that are not soft-deleted at `as_of`."""
    return users.filter(F.col("deleted_at").isNull() | (F.col("deleted_at") > ts(as_of)))


def user_cohorts(users: DataFrame, as_of: Moment) -> DataFrame:
    """Monday of each active user's sign-up week."""
    return active_users(users, as_of).select(
        "user_id", week_start("created_at").alias("cohort_week")
    )


def weekly_cohort_metrics(
    events: DataFrame,
    users: DataFrame,
    cohorts: DataFrame,
    as_of: Moment,
    time_col: str = "created_at",
) -> DataFrame:
    """Events and distinct users per cohort in the seven days before `as_of`.

    Events are counted per user before they meet the dimensions. That leaves one
    row per user: a very active user cannot skew the joins, and the number of
    distinct users is a plain count.
    """
    end = day(as_of)
    start = F.date_sub(end, 7)
    in_week = (F.col(time_col) >= start.cast("timestamp")) & (
        F.col(time_col) < end.cast("timestamp")
    )
    per_user = (
        events.filter(in_week & F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count("id").alias("_n"))
    )
    return (
        per_user.join(users.select("user_id"), "user_id")
        .join(cohorts.select("user_id", "cohort_week"), "user_id")
        .groupBy("cohort_week")
        .agg(sum_long("_n").alias("event_count"), F.count(F.lit(1)).alias("unique_users"))
        .select(
            "cohort_week",
            week_start(end).alias("report_week"),
            "event_count",
            "unique_users",
        )
    )


def monthly_kpis(
    events: DataFrame,
    months: list[str] | None = None,
    time_col: str = "created_at",
    event_type: str = "purchase",
    field: str = "amount",
    amount_col: str | None = None,
) -> DataFrame:
    """Purchases, distinct buyers and mean amount per month, with the change to the month before.

    `months` ("YYYY-MM") are all reported, with zeros and a warning flag for those
    without purchases. A change is only given if the previous calendar month is
    part of the result. Amounts come at full precision from the payload of
    purchases, or from `amount_col`, which saves reading the payload.
    """
    purchases = events.filter(F.col("event_type") == event_type)
    if months:
        first, last = month_interval(min(months)), month_interval(max(months))
        purchases = purchases.filter(in_interval(time_col, (first[0], last[1])))
    if amount_col is None:
        amount = safe_amount("payload", field, WIDE_AMOUNT)
    else:
        amount = F.col(amount_col).cast(WIDE_AMOUNT)
    kpis = (
        purchases.select(
            month_start(time_col).alias("_month"), "user_id", amount.alias("_amount")
        )
        .groupBy("_month")
        .agg(
            F.count(F.lit(1)).alias("total_purchases"),
            F.count_distinct("user_id").alias("unique_buyers"),
            F.sum("_amount").alias("_sum"),
            F.count("_amount").alias("_priced"),
        )
        .select(
            "_month",
            "total_purchases",
            "unique_buyers",
            F.coalesce(mean2("_sum", "_priced"), F.lit(0.0)).alias("avg_amount"),
        )
    )
    if months:
        spark = events.sparkSession
        wanted = spark.createDataFrame(
            [(month_interval(m)[0].date(),) for m in sorted(set(months))], "_month DATE"
        )
        kpis = wanted.join(kpis, "_month", "left").na.fill(
            0, ["total_purchases", "unique_buyers", "avg_amount"]
        )
    # One row per month: a single small partition.
    by_month = Window.partitionBy().orderBy("_month")
    consecutive = F.lag("_month").over(by_month) == F.add_months("_month", -1)

    def before(c: str):
        return F.when(consecutive, F.lag(c).over(by_month))

    return kpis.withColumns(
        {"_previous": before("total_purchases"), "_previous_avg": before("avg_amount")}
    ).select(
        F.date_format("_month", "yyyy-MM").alias("report_month"),
        "total_purchases",
        "unique_buyers",
        "avg_amount",
        (F.col("total_purchases") == 0).alias("is_zero_warning"),
        (F.col("total_purchases") - F.col("_previous")).alias("purchases_change"),
        F.round(F.col("avg_amount") - F.col("_previous_avg"), 2).alias("avg_amount_change"),
    )


def storable_kpis(kpis: DataFrame) -> DataFrame:
    """Months without purchases are warned about, not stored."""
    return kpis.filter(~F.col("is_zero_warning")).select(
        "report_month", "total_purchases", "unique_buyers", "avg_amount"
    )


def error_summary(
    errors: DataFrame,
    every: str = "2 hours",
    critical_types: tuple[str, ...] = ("auth_error",),
    max_total: int = 1000,
    iv: Interval | None = None,
    time_col: str = "occurred_at",
) -> DataFrame:
    """Errors per type and window, their share, and whether the window is critical.

    A window is critical with any error of a critical type or with more than
    `max_total` errors.
    """
    if iv is not None:
        errors = errors.filter(in_interval(time_col, iv))
    window = Window.partitionBy("window_start")
    total = F.sum("error_count").over(window)
    critical = F.max(F.col("error_type").isin(list(critical_types))).over(window)
    return (
        errors.groupBy(bucket_start(time_col, every).alias("window_start"), "error_type")
        .agg(F.count(F.lit(1)).alias("error_count"))
        .select(
            "window_start",
            "error_type",
            "error_count",
            pct2("error_count", total).alias("pct_of_total"),
            (F.coalesce(critical, F.lit(False)) | (total > max_total)).alias("is_critical"),
        )
    )

