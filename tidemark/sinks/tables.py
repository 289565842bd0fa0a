"""Keyed and interval-wise writes to partitioned Parquet.

The pure functions return the resulting table as a DataFrame. The `*_table`
functions apply them to a path with dynamic partition overwrite: new files are
staged by the commit protocol, so a failed job leaves the old partitions intact
and a repeated one gives the same table.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import Interval, require_whole, seconds_of
from tidemark.layout import Layout
from tidemark.sinks import storage


def sort_for_pruning(df: DataFrame, *cols: str) -> DataFrame:
    """Order rows within files, which makes row-group statistics selective."""
    return df.sortWithinPartitions(*cols)


def _write_partitions(df: DataFrame, path: str, partition_cols: tuple[str, ...]) -> None:
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def _balanced(df: DataFrame, partition_cols: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """Group rows by target partition without letting a hot one become a single task.

    The rebalance hint lets the runtime split large partitions and merge small
    ones, so file sizes follow the advisory partition size.
    """
    return sort_for_pruning(df.hint("rebalance", *partition_cols), *partition_cols, *order)


def replace_interval(
    df: DataFrame,
    path: str,
    layout: Layout,
    iv: Interval | None = None,
    time_col: str = "created_at",
    leading: str | None = None,
) -> None:
    """Replace every partition that has rows in `df`.

    With `iv`, partitions of the interval that received no rows are removed too,
    so that the table holds exactly the rows of `df` for that interval. Which
    ones received rows is observed during the write; the set is as long as the
    interval has partitions. The interval has to consist of whole partitions.
    With `leading`, the table is partitioned by that text column first, and the
    interval is replaced for all of its values, those without rows in `df` too.
    """
    if iv is not None:
        require_whole(iv, layout.every)
    columns = ((leading,) if leading else ()) + layout.columns
    placed = _balanced(layout.assign(df, time_col), columns, (time_col,))
    if iv is None:
        _write_partitions(placed, path, columns)
        return
    wanted = layout.directories(iv)
    if leading:
        tops = storage.children(df.sparkSession, path)
        tops = sorted(t for t in tops if t.startswith(f"{leading}="))
        wanted = [f"{top}/{d}" for top in tops for d in wanted]
    _replace_directories(placed, path, columns, wanted)


def replace_buckets(
    df: DataFrame, path: str, layout: Layout, starts: list[datetime], time_col: str
) -> None:
    """Replace the partitions that begin at `starts`; those without rows in `df` are removed.

    `df` has rows of these partitions only.
    """
    step = timedelta(seconds=seconds_of(layout.every))
    wanted = [d for start in starts for d in layout.directories((start, start + step))]
    placed = _balanced(layout.assign(df, time_col), layout.columns, (time_col,))
    _replace_directories(placed, path, layout.columns, wanted)


def _replace_directories(
    placed: DataFrame, path: str, columns: tuple[str, ...], wanted: list[str]
) -> None:
    """Write partitions and remove those of `wanted` that got no rows."""
    spark = placed.sparkSession
    before = storage.present(spark, path, wanted)
    written = Observation()
    name = [F.concat(F.lit(f"{c}="), _directory_value(c)) for c in columns]
    _write_partitions(
        placed.observe(written, F.collect_set(F.concat_ws("/", *name)).alias("directories")),
        path,
        columns,
    )
    got = set(written.get["directories"])
    stale = sorted(d for d in before if unquote(d) not in got)
    storage.delete_all(spark, (f"{path.rstrip('/')}/{d}" for d in stale))


def _directory_value(column: str) -> Column:
    """What the directory of a partition value is called, before special characters are quoted."""
    text = F.col(column).cast("string")
    return F.when(text.isNull() | (text == ""), "__HIVE_DEFAULT_PARTITION__").otherwise(text)


def replace_partitions(
    df: DataFrame, path: str, partition_cols: tuple[str, ...], order: tuple[str, ...] = ()
) -> None:
    """Replace the partitions that occur in `df`, keeping all others."""
    _write_partitions(_balanced(df, partition_cols, order), path, partition_cols)


def replace_window(df: DataFrame, path: str, label: str) -> None:
    """Replace the one partition `window=<label>`, also when there is nothing to write."""
    replace_table(df, f"{path.rstrip('/')}/window={label}")


def replace_table(df: DataFrame, path: str, partition_cols: tuple[str, ...] = ()) -> None:
    """Replace a whole table: write the new version beside it, then swap it in."""
    staged = storage.beside(path, "staged")
    storage.recover(df.sparkSession, path)
    rows = df.hint("rebalance", *partition_cols)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partition_cols)
        .parquet(staged)
    )
    storage.swap_in(df.sparkSession, staged, path)


def _same(left: str, right: str, keys: tuple[str, ...]) -> Column:
    # Null-safe, so that a row with a NULL key part replaces its predecessor.
    return reduce(
        lambda a, b: a & b,
        [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys],
    )


def upsert(
    target: DataFrame, src: DataFrame, keys: tuple[str, ...], keep_cols: tuple[str, ...] = ()
) -> DataFrame:
    """Table after insert-or-replace: the incoming row wins on equal keys.

    `keep_cols` retain the stored value of rows that already exist. Of source rows
    with equal keys the least by the other columns counts.
    """
    src = one_per_key(src, keys)
    untouched = target.alias("t").join(src.alias("s"), _same("t", "s", keys), "left_anti")
    if keep_cols:
        stored = target.select(*keys, *keep_cols, F.lit(True).alias("_found"))
        src = (
            src.alias("s")
            .join(stored.alias("t"), _same("s", "t", keys), "left")
            .select(
                *[
                    F.when(F.col("t._found"), F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
                    if c in keep_cols
                    else F.col(f"s.{c}")
                    for c in target.columns
                ]
            )
        )
    return untouched.unionByName(src)


def one_per_key(src: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per key: the least by its other columns."""
    rest = [c for c in src.columns if c not in keys]
    if not rest:
        return src.distinct()
    first = Window.partitionBy(*keys).orderBy(*rest)
    return src.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def absent_rows(target: DataFrame, src: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows of `src` whose key the target lacks, one per key (the least by its other columns)."""
    return one_per_key(src, keys).alias("s").join(target.alias("t"), _same("s", "t", keys), "left_anti")


def insert_if_absent(target: DataFrame, src: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Table after inserting only new keys; existing rows keep their values."""
    return target.unionByName(absent_rows(target, src, keys))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table, its old version if a swap was cut off, or no rows if it was never written."""
    for version in (path, storage.retired(path)):
        if storage.exists(spark, version):
            return spark.read.schema(schema).parquet(version)
    return spark.createDataFrame([], schema)


def upsert_table(
    src: DataFrame,
    path: str,
    keys: tuple[str, ...],
    partition_cols: tuple[str, ...],
    keep_cols: tuple[str, ...] = (),
    scope: Column | None = None,
) -> None:
    """Upsert into a partitioned table, rewriting only the partitions `src` touches.

    Partition columns have to be part of the key: otherwise a row could move to
    another partition and its old version would survive. `scope` is a predicate
    on partition columns that selects whole partitions, at least those `src`
    touches and no more than may be rewritten; without it, they are found from
    `src`, which is then evaluated once more.
    """
    _check_partitions(keys, partition_cols)
    order = tuple(k for k in keys if k not in partition_cols)
    if not storage.exists(src.sparkSession, path):
        replace_partitions(src, path, partition_cols, order)
        return
    current = src.sparkSession.read.schema(src.schema).parquet(path)
    affected = touched(current, src, partition_cols) if scope is None else current.filter(scope)
    replace_partitions(upsert(affected, src, keys, keep_cols), path, partition_cols, order)


def touched(current: DataFrame, src: DataFrame, partition_cols: tuple[str, ...]) -> DataFrame:
    """Rows of a table in the partitions that occur in `src`.

    The partitions that a write touches are directories, few enough to name; naming them lets
    the scan list and read no others.
    """
    names = src.select(*partition_cols).distinct().collect()
    for c in partition_cols:
        values = {row[c] for row in names}
        there = F.col(c).isin(*(values - {None}))
        current = current.filter(there | F.col(c).isNull() if None in values else there)
    if len(partition_cols) > 1:
        own = src.sparkSession.createDataFrame(names, src.select(*partition_cols).schema)
        current = current.alias("t").join(
            own.alias("s"), _same("t", "s", partition_cols), "left_semi"
        )
    return current.select(*src.columns)


def _check_partitions(keys: tuple[str, ...], partition_cols: tuple[str, ...]) -> None:
    if not set(partition_cols) <= set(keys):
        raise ValueError(f"partition columns {partition_cols} must be part of the key {keys}")


def upsert_small_table(
    src: DataFrame, path: str, keys: tuple[str, ...], keep_cols: tuple[str, ...] = ()
) -> None:
    """Upsert into an unpartitioned report table: write the new version, then swap it in."""
    spark = src.sparkSession
    storage.recover(spark, path)
    replace_table(upsert(read_or_empty(spark, path, src.schema), src, keys, keep_cols), path)


def append_absent(
    src: DataFrame,
    path: str,
    keys: tuple[str, ...],
    partition_cols: tuple[str, ...] = (),
    scope: Column | None = None,
) -> None:
    """Append the rows whose key is new, so a repeated run adds nothing.

    `scope` is a predicate that all rows of `src` satisfy; it prunes the part of
    the table they are compared with.
    """
    _check_partitions(keys, partition_cols)
    target = read_or_empty(src.sparkSession, path, src.schema)
    if scope is not None:
        target = target.filter(scope)
    new = absent_rows(target, src, keys).select(*src.columns)
    if partition_cols:
        new = _balanced(new, partition_cols, ())
    new.write.mode("append").partitionBy(*partition_cols).parquet(path)


def append_log(df: DataFrame, path: str) -> None:
    """Append measurements; one row per check, passed or failed."""
    df.write.mode("append").parquet(path)


def soft_delete(users: DataFrame, ids: DataFrame, as_of: Column) -> DataFrame:
    """Users with deleted_at set for the listed ids, where it was still empty.

    Both sides meet in one join on user_id; ids never pass through the driver.
    """
    if "deleted_at" not in users.columns:
        users = users.withColumn("deleted_at", F.lit(None).cast("timestamp"))
    marked = ids.select("user_id").distinct().withColumn("_listed", F.lit(True))
    return (
        users.join(marked, "user_id", "left")
        .withColumn(
            "deleted_at", F.coalesce("deleted_at", F.when(F.col("_listed"), as_of))
        )
        .select(*users.columns)
    )
