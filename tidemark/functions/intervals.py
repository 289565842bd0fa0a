"""Half-open intervals, time buckets and date spines."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Moment = str | date | datetime
Interval = tuple[Moment, Moment]

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def moment(value: Moment) -> datetime:
    """Naive UTC datetime of a date, datetime or ISO string."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def ts(value: Moment | Column) -> Column:
    """Timestamp literal. It folds to a constant, so comparisons push down."""
    if isinstance(value, Column):
        return value
    return F.lit(moment(value).isoformat(sep=" ") + "Z").cast("timestamp")


def day(value: Moment | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(moment(value).date().isoformat()).cast("date")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_interval(c: str | Column, iv: Interval) -> Column:
    """`start <= c < end` on the bare column, so the scan can prune row groups."""
    start, end = iv
    return (_col(c) >= ts(start)) & (_col(c) < ts(end))


def since(c: str | Column, as_of: Moment, days: int) -> Column:
    """Rows at most `days` days older than `as_of`."""
    return _col(c) >= ts(moment(as_of) - timedelta(days=days))


def seconds_of(every: str) -> int:
    """Length of a bucket such as "1 hour" or "2 hours"."""
    amount, unit = every.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")]


def bucket_start(c: str | Column, every: str) -> Column:
    """Start of the epoch-aligned bucket that holds the timestamp."""
    seconds = F.unix_seconds(_col(c))
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(seconds_of(every)).cast("bigint")))


def bucket_end(start: str | Column, every: str) -> Column:
    return F.timestamp_seconds(F.unix_seconds(_col(start)) + seconds_of(every))


def _epoch(value: datetime) -> int:
    return int((value - datetime(1970, 1, 1)).total_seconds())


def bucket_count(iv: Interval, every: str) -> int:
    """Number of buckets that overlap the interval; known before any job runs."""
    step = seconds_of(every)
    first = _epoch(moment(iv[0])) // step
    end = moment(iv[1])
    last = -((-_epoch(end) - (1 if end.microsecond else 0)) // step)
    return max(last - first, 0)


def require_whole(iv: Interval, every: str) -> None:
    """Refuse an interval that would replace a bucket with a part of its rows."""
    step = timedelta(seconds=seconds_of(every))
    for edge in iv:
        if (moment(edge) - datetime(1970, 1, 1)) % step:
            raise ValueError(f"{edge} is not a boundary of {every}")


def spine(spark: SparkSession, iv: Interval, every: str, name: str = "window_start") -> DataFrame:
    """One row per bucket of the interval, generated in parallel."""
    step = seconds_of(every)
    first = _epoch(moment(iv[0])) // step
    return spark.range(first, first + bucket_count(iv, every)).select(
        F.timestamp_seconds(F.col("id") * step).alias(name)
    )


def date_spine(spark: SparkSession, first: Moment, days: int, name: str) -> DataFrame:
    origin = moment(first).date().isoformat()
    return spark.range(days).select(
        F.date_add(F.lit(origin).cast("date"), F.col("id").cast("int")).alias(name)
    )


def hour_of(c: str | Column) -> Column:
    return F.hour(_col(c)).cast("int")


def week_start(c: str | Column) -> Column:
    """Monday of the week."""
    return F.date_trunc("week", _col(c)).cast("date")


def month_start(c: str | Column) -> Column:
    return F.trunc(_col(c).cast("date"), "MM")


def previous_day(as_of: Moment) -> Interval:
    """The whole UTC day before the day of `as_of`."""
    end = moment(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return end - timedelta(days=1), end


def previous_month(as_of: Moment) -> str:
    """Label "YYYY-MM" of the calendar month before `as_of`."""
    first = moment(as_of).replace(day=1)
    return (first - timedelta(days=1)).strftime("%Y-%m")


def month_interval(month: str) -> Interval:
    first = datetime.fromisoformat(f"{month}-01")
    return first, (first + timedelta(days=32)).replace(day=1)
