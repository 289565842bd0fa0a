"""Predicates that split a table where its rows are, not where its values are.

Equal-width bounds give most of a skewed table to a few readers. Here the rows are counted in
buckets of the split column, buckets with more rows than a reader should get are counted again
more finely, and bounds are set between buckets so that the readers get about equally many. A
single value with too many rows can be spread by the remainder of a second column.

The predicates cover the whole table: the first one has no lower and the last one no upper
bound, so rows that came after the counting are read too, and rows without a value have a
predicate of their own. Every row satisfies exactly one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of one counting; the driver gets one row per bucket that holds rows.
BUCKETS = 4096
_EPOCH = datetime(1970, 1, 1)

#: counts(low, high, width): rows per bucket number of low <= value < high.
Counts = Callable[[int, int, int], dict[int, int]]


@dataclass(frozen=True)
class SplitColumn:
    """A whole number or a timestamp, which is then split by its microseconds since 1970."""

    name: str
    is_time: bool = False

    def literal(self, value: int) -> str:
        if not self.is_time:
            return str(value)
        when = _EPOCH + timedelta(microseconds=value)
        return f"TIMESTAMP '{when.isoformat(sep=' ', timespec='microseconds')}'"

    def number(self, value: datetime | int) -> int:
        if not self.is_time:
            return int(value)
        if value.tzinfo:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        return (value - _EPOCH) // timedelta(microseconds=1)


def frame_counts(df: DataFrame, column: SplitColumn) -> Counts:
    """Counts of a DataFrame, which can be a JDBC table: the grouping runs where Spark runs it."""
    value = F.unix_micros(column.name) if column.is_time else F.col(column.name)

    def counts(low: int, high: int, width: int) -> dict[int, int]:
        inside = df.select(value.alias("v")).filter((F.col("v") >= low) & (F.col("v") < high))
        bucket = F.call_function("div", F.col("v") - low, F.lit(width))
        rows = inside.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
        return {r.b: r.n for r in rows}

    return counts


def database_counts(
    spark: SparkSession,
    url: str,
    table: str,
    column: SplitColumn,
    micros: str = "CAST(EXTRACT(EPOCH FROM {0}) * 1000000 AS BIGINT)",
    **extra: str,
) -> Counts:
    """Counts that the database makes. `micros` is its expression for the microseconds of a time."""

    def counts(low: int, high: int, width: int) -> dict[int, int]:
        query = count_query(table, column, micros, low, high, width)
        rows = spark.read.format("jdbc").options(url=url, query=query, **extra).load().collect()
        return {int(r[0]): int(r[1]) for r in rows}

    return counts


def count_query(
    table: str, column: SplitColumn, micros: str, low: int, high: int, width: int
) -> str:
    value = micros.format(column.name) if column.is_time else column.name
    bucket = f"FLOOR(({value} - ({low})) / {width})"
    return (
        f"SELECT {bucket} AS b, COUNT(*) AS n FROM {table}"
        f" WHERE {column.name} >= {column.literal(low)} AND {column.name} < {column.literal(high)}"
        f" GROUP BY {bucket}"
    )


def _ranges(counts: Counts, low: int, high: int, most: float, buckets: int) -> list[tuple[int, int, int]]:
    """(start, stop, rows) in order, each with at most `most` rows or a single value."""
    width = max(1, -(-(high - low) // buckets))
    out = []
    for bucket, rows in sorted(counts(low, high, width).items()):
        start = low + bucket * width
        stop = min(high, start + width)
        if rows > most and stop - start > 1:
            out += _ranges(counts, start, stop, most, buckets)
        else:
            out.append((start, stop, rows))
    return out


def split_predicates(
    counts: Counts,
    column: SplitColumn,
    low: int,
    high: int,
    parts: int,
    spread: str | None = None,
    buckets: int = BUCKETS,
) -> list[str]:
    """Predicates for about `parts` readers of the values low <= value < high, and of all
    others. No reader gets more than twice the mean of `parts`, but for a single value with
    more rows than that, which the whole-number column `spread` divides if there is one.
    """
    total = sum(counts(low, high, max(1, high - low)).values())
    mean = max(1.0, total / parts)
    # Fine enough that a reader misses its share by a quarter at most.
    ranges = _ranges(counts, low, high, mean / 4, buckets) if total else []
    name, groups, size = column.name, [], 0
    for start, stop, rows in ranges:
        heavy = rows > mean and stop - start == 1
        if not groups or heavy or groups[-1][2] or size + rows > 1.25 * mean:
            groups.append((start, rows, heavy))
            size = rows
        else:
            first, before, _ = groups[-1]
            groups[-1] = (first, before + rows, False)
            size += rows
    out = []
    for i, (start, rows, heavy) in enumerate(groups):
        lower = [f"{name} >= {column.literal(start)}"] if i else []
        upper = [f"{name} < {column.literal(groups[i + 1][0])}"] if i + 1 < len(groups) else []
        own = " AND ".join(lower + upper) or f"{name} IS NOT NULL"
        pieces = -(-rows // int(mean)) if heavy and spread else 1
        if pieces == 1:
            out.append(own)
            continue
        rest = f"MOD(MOD({spread}, {pieces}) + {pieces}, {pieces})"
        out += [f"{own} AND {rest} = {j}" for j in range(pieces)]
        out.append(f"{own} AND {spread} IS NULL")
    return [*(out or [f"{name} IS NOT NULL"]), f"{name} IS NULL"]


def read_split_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: SplitColumn,
    low: int,
    high: int,
    parts: int,
    spread: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table, each task reading about as many rows as the others."""
    counts = database_counts(spark, url, table, column, **(properties or {}))
    predicates = split_predicates(counts, column, low, high, parts, spread)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})
