"""Where the tables of a lake live."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import Interval, moment
from tidemark.sinks.tables import read_or_empty
from tidemark.sources.landing import read_landing


@dataclass(frozen=True)
class Lake:
    """Root directory with landing, bronze, gold, tables, logs and checkpoints below it."""

    root: str

    def _path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def landing(self) -> str:
        return self._path("landing")

    @property
    def tenant_landing(self) -> str:
        return self._path("landing_tenants")

    @property
    def bronze(self) -> str:
        return self._path("bronze")

    def gold(self, name: str) -> str:
        return self._path("gold", name)

    def table(self, name: str) -> str:
        return self._path("tables", name)

    def log(self, name: str) -> str:
        return self._path("logs", name)

    def checkpoint(self, name: str) -> str:
        return self._path("checkpoints", name)

    def events(self, spark: SparkSession, iv: Interval | None = None) -> DataFrame:
        return read_landing(spark, self.landing, iv=iv)

    def read(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        """A source table; one that was never written is empty."""
        return read_or_empty(spark, self.table(name), schema)


def window_label(iv: Interval) -> str:
    """Directory label of a processing window, start and end."""
    return "-".join(moment(edge).strftime("%Y%m%dT%H%M%S") for edge in iv)


def trailing(as_of, days: int) -> Interval:
    """The `days` whole days up to the start of the day of `as_of`."""
    end = moment(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return end - timedelta(days=days), end


def dates_of(column: str, iv: Interval) -> Column:
    """Predicate on a date partition: the dates an interval touches."""
    start, end = moment(iv[0]), moment(iv[1]) - timedelta(microseconds=1)
    return F.col(column).between(F.lit(start.date()), F.lit(end.date()))
