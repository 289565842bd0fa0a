"""Ranking, auditing and removal of duplicate events.

Events are duplicates if they agree on the key columns and on the time cut to a
grain (one second). The lowest id is the original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.intervals import bucket_start
from tidemark.session import scratch_dir

DUPLICATE_KEYS = ("user_id", "event_type")
#: Rows of a group that one task ranks, and hash cells in which larger groups are looked for.
BOUND, CELLS = 1 << 20, 1 << 16


def _group_key(keys: tuple[str, ...], grain: str, time_col: str) -> Column:
    # A struct is never NULL itself, so rows with NULL keys group and join alike.
    return F.struct(*[F.col(k) for k in keys], F.date_trunc(grain, time_col).alias("_slot"))


def key_ranges(rows: DataFrame, key: str, order: str, ranges: int | None = None) -> DataFrame:
    """`rows` with `_range`: consecutive ranges of (key, order) with about equally many rows.

    The ranges are quantiles, so a key with very many rows spans several of them. They are
    written once to the shared folder: whoever reads them sees the same ranges.
    """
    path = f"{scratch_dir(rows.sparkSession, 'ranges')}/rows"
    parts = () if ranges is None else (ranges,)
    ranged = rows.repartitionByRange(*parts, key, order).withColumn(
        "_range", F.spark_partition_id()
    )
    ranged.write.parquet(path)
    return rows.sparkSession.read.schema(ranged.schema).parquet(path)


def crowded_cells(rows: DataFrame, key: str, bound: int, cells: int = CELLS) -> DataFrame:
    """(_cell, _rows) of the hash cells that hold more than `bound` rows.

    A key with more than `bound` rows lies in such a cell. Each task sends one count per cell,
    so looking for hot keys costs far less than grouping by key. There are at most
    rows / `bound` of them.
    """
    return (
        rows.groupBy(_cell(key, cells).alias("_cell"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > bound)
    )


def _cell(key: str, cells: int = CELLS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(cells))


def _ranked_by_ranges(rows: DataFrame, ranges: int) -> DataFrame:
    """Ranks within ranges of (group, id), and the rows of a group in earlier ranges added."""
    placed = key_ranges(rows, "_key", "event_id", ranges)
    inner = Window.partitionBy("_range", "_key").orderBy("event_id")
    ranked = placed.withColumn("_rn", F.row_number().over(inner))
    # One row per group and range; only groups of several ranges stay.
    lower = Window.partitionBy("_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        placed.groupBy("_range", "_key")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", "_key", F.sum("_n").over(lower).alias("_before"))
        .filter(F.col("_before").isNotNull())
    )
    return ranked.join(before, ["_range", "_key"], "left").select(
        "event_id", "window_start", (F.col("_rn") + F.coalesce("_before", F.lit(0))).alias("rn")
    )


def duplicate_rank(
    events: DataFrame,
    keys: tuple[str, ...] = DUPLICATE_KEYS,
    grain: str = "second",
    order: str = "id",
    time_col: str = "created_at",
    every: str = "1 hour",
    bound: int = BOUND,
) -> DataFrame:
    """(event_id, window_start, rn) for every row; rn = 1 is the original.

    Groups are ranked by a window, one shuffle of four narrow columns. Those that may have more
    than `bound` rows are found first, by counts of hash cells; they go through ranges of
    (group, id) of at most about `bound` rows, so no task gets a whole hot group.
    """
    rows = events.select(
        F.col(order).alias("event_id"),
        bucket_start(time_col, every).alias("window_start"),
        _group_key(keys, grain, time_col).alias("_key"),
    )
    by_id = Window.partitionBy("_key").orderBy("event_id")
    # One row per `bound` rows of input at most, and usually none.
    crowded = crowded_cells(rows, "_key", bound).collect()
    if not crowded:
        ranked = rows.withColumn("rn", F.row_number().over(by_id))
        return ranked.select("event_id", "window_start", F.col("rn").cast("bigint").alias("rn"))
    listed = rows.sparkSession.createDataFrame(crowded, "_cell BIGINT, _rows BIGINT").select("_cell")
    celled = rows.withColumn("_cell", _cell("_key"))
    rest = celled.join(listed, "_cell", "left_anti").drop("_cell")
    hot = celled.join(listed, "_cell", "left_semi").drop("_cell")
    ranges = -(-sum(r["_rows"] for r in crowded) // bound)
    ranked = rest.withColumn("rn", F.row_number().over(by_id)).drop("_key")
    ranked = ranked.unionByName(_ranked_by_ranges(hot, ranges))
    return ranked.select("event_id", "window_start", F.col("rn").cast("bigint").alias("rn"))


def duplicate_audit(events: DataFrame, **options) -> DataFrame:
    """The copies (rn > 1) with the interval they fall into."""
    return duplicate_rank(events, **options).filter(F.col("rn") > 1)


def duplicate_counts(
    events: DataFrame,
    keys: tuple[str, ...] = DUPLICATE_KEYS,
    grain: str = "second",
    time_col: str = "created_at",
    every: str = "1 hour",
) -> DataFrame:
    """Copies per interval. Counting needs no ranking: a group of n rows has n - 1 copies."""
    return (
        events.groupBy(
            bucket_start(time_col, every).alias("window_start"),
            _group_key(keys, grain, time_col).alias("_key"),
        )
        .agg(F.count(F.lit(1)).alias("_n"))
        .groupBy("window_start")
        .agg(
            F.sum("_n").cast("bigint").alias("total_rows"),
            F.sum(F.col("_n") - 1).cast("bigint").alias("duplicate_count"),
        )
    )


def deduplicate(
    events: DataFrame,
    keys: tuple[str, ...] = DUPLICATE_KEYS,
    grain: str = "second",
    order: str = "id",
    time_col: str = "created_at",
) -> DataFrame:
    """The original of every duplicate group, all columns kept.

    Because only rank 1 is asked for, each map task keeps one row per group
    before the shuffle, however many copies a group has.
    """
    first = Window.partitionBy(_group_key(keys, grain, time_col)).orderBy(order)
    return events.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")
