"""Directory layouts: which partition columns a table has and how an interval maps to them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, bucket_count, moment, seconds_of, ts


@dataclass(frozen=True)
class Layout:
    """Time partitioning of a table; without columns, the directories are unnamed."""

    columns: tuple[str, ...]
    every: str
    values: Callable[[Column], dict[str, Column]]
    start: Callable[[], Column]
    directory: Callable[[datetime], str]

    def assign(self, df: DataFrame, time_col: str) -> DataFrame:
        return df.withColumns(self.values(F.col(time_col)))

    def covers(self, iv: Interval) -> Column:
        """Predicate on the partition columns alone, so that listing is pruned."""
        if not self.columns:
            return F.lit(True)
        step = timedelta(seconds=seconds_of(self.every))
        begin, end = moment(iv[0]), moment(iv[1])
        return (self.start() > ts(begin - step)) & (self.start() < ts(end))

    def directories(self, iv: Interval) -> list[str]:
        """Partition directories of an interval; their number follows from its length."""
        step = timedelta(seconds=seconds_of(self.every))
        begin = moment(iv[0])
        begin -= (begin - datetime(1970, 1, 1)) % step
        return [self.directory(begin + i * step) for i in range(bucket_count(iv, self.every))]


HOURLY = Layout(
    columns=("year", "month", "day", "hour"),
    every="1 hour",
    values=lambda c: {
        "year": F.year(c),
        "month": F.month(c),
        "day": F.dayofmonth(c),
        "hour": F.hour(c),
    },
    start=lambda: F.make_timestamp(
        F.col("year"), F.col("month"), F.col("day"), F.col("hour"), F.lit(0), F.lit(0)
    ),
    directory=lambda m: f"year={m.year}/month={m.month}/day={m.day}/hour={m.hour}",
)

DAILY = Layout(
    columns=("dt",),
    every="1 day",
    values=lambda c: {"dt": c.cast("date")},
    start=lambda: F.col("dt").cast("timestamp"),
    directory=lambda m: f"dt={m.date().isoformat()}",
)

# Directories YYYY/MM/DD/HH that carry no column names; read-only.
PLAIN_HOURS = Layout(
    columns=(),
    every="1 hour",
    values=lambda c: {},
    start=lambda: F.lit(None),
    directory=lambda m: m.strftime("%Y/%m/%d/%H"),
)
