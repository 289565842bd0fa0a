"""Inactive users, retention, partition gaps and compaction."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.intervals import Moment, date_spine, in_interval, moment, since, ts
from tidemark.operators.reports import active_users
from tidemark.sinks import storage
from tidemark.sources.files import list_files, partition_dates

INACTIVITY_DAYS = 180
METRICS_RETENTION_DAYS = 90
LANDING_RETENTION_DAYS = 30
BACKFILL_LOOKBACK_DAYS = 7
TARGET_FILE_BYTES = 128 * 1024 * 1024


def inactive_users(
    users: DataFrame,
    events: DataFrame,
    as_of: Moment,
    days: int = INACTIVITY_DAYS,
    limit: int | None = None,
    time_col: str = "created_at",
) -> DataFrame:
    """Active accounts older than `days` without an event in the last `days` days.

    Recent events are reduced to distinct users before the anti join, on the map
    side first, so a very active user costs one row per task. `limit` takes the
    lowest user ids.
    """
    recent = (
        events.filter(since(time_col, as_of, days) & (F.col(time_col) <= ts(as_of)))
        .filter(F.col("user_id").isNotNull())
        .select("user_id")
        .distinct()
    )
    idle = (
        active_users(users, as_of)
        .filter(~since("created_at", as_of, days))
        .join(recent, "user_id", "left_anti")
        .select("user_id", "email", "created_at")
    )
    return idle if limit is None else idle.orderBy("user_id").limit(limit)


def retain(
    df: DataFrame, time_col: str, as_of: Moment, days: int = METRICS_RETENTION_DAYS
) -> DataFrame:
    """Rows that survive the retention period."""
    return df.filter(since(time_col, as_of, days))


def retention_stats(
    df: DataFrame, time_col: str, as_of: Moment, days: int = METRICS_RETENTION_DAYS
) -> DataFrame:
    """Rows before, deleted and after, in one pass."""
    expired = ~since(time_col, as_of, days)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(expired).alias("rows_deleted")
    ).withColumn("rows_after", F.col("rows_before") - F.col("rows_deleted"))


def file_retention_plan(
    files: DataFrame, as_of: Moment, days: int = LANDING_RETENTION_DAYS
) -> DataFrame:
    """Age of every file in whole days; expired once that exceeds `days`."""
    seconds = F.unix_seconds(ts(as_of)) - F.unix_seconds("modified_at")
    age = F.floor(seconds / F.lit(86400)).cast("int")
    return files.select(
        "path", "size", "modified_at", age.alias("age_days"), (age > days).alias("expired")
    )


def partition_retention_plan(
    files: DataFrame, as_of: Moment, days: int = LANDING_RETENTION_DAYS
) -> DataFrame:
    """(partition_date, age_days, expired) of the dates that have files, by their directories.

    A date expires whole; its age does not depend on when its files were last written.
    """
    age = F.date_diff(ts(as_of).cast("date"), F.col("dt"))
    return partition_dates(files).select(
        F.col("dt").alias("partition_date"), age.alias("age_days"), (age > days).alias("expired")
    )


def apply_retention(plan: DataFrame, dry_run: bool = True) -> DataFrame:
    """Delete the expired files unless `dry_run`; returns file and byte totals per decision.

    A directory whose files have all expired goes with one call; only in the others are files
    deleted one by one. Paths reach the driver a partition of the plan at a time and are
    deleted by a pool of threads, as these are calls to the name node.
    """
    summary = plan.groupBy("expired").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").cast("bigint").alias("bytes")
    )
    if dry_run:
        return summary
    spark = plan.sparkSession
    done = spark.createDataFrame(summary.collect(), summary.schema)
    placed = plan.withColumn("_directory", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
    found = placed.groupBy("_directory").agg(
        F.every("expired").alias("_whole"), F.some("expired").alias("_some")
    )
    whole = found.filter("_whole").select(F.col("_directory").alias("path"))
    partly = placed.join(found.filter("_some and not _whole"), "_directory").filter("expired")
    expired = whole.union(partly.select("path")).toLocalIterator()
    storage.delete_all(spark, (row.path for row in expired))
    return done


def missing_partitions(
    present: DataFrame, as_of: Moment, lookback: int = BACKFILL_LOOKBACK_DAYS
) -> DataFrame:
    """Dates of the last `lookback` days, run date excluded, that have no data; oldest first."""
    first = moment(as_of) - timedelta(days=lookback)
    spine = date_spine(present.sparkSession, first, lookback, "dt")
    return spine.join(present.select("dt").distinct(), "dt", "left_anti").orderBy("dt")


def backfill(
    events: DataFrame,
    missing: DataFrame,
    operator: Callable[[DataFrame], DataFrame],
    as_of: Moment,
    lookback: int = BACKFILL_LOOKBACK_DAYS,
    time_col: str = "created_at",
) -> DataFrame:
    """Apply an operator to the events of the missing dates only, in one job.

    Only dates of the look-back period count, so the broadcast set has at most
    `lookback` rows. The operator has to group by day itself.
    """
    end = moment(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    period = (end - timedelta(days=lookback), end)
    in_period = (F.col("dt") >= F.lit(period[0].date())) & (F.col("dt") < F.lit(end.date()))
    dates = F.broadcast(missing.filter(in_period).select(F.col("dt").alias("_dt")).distinct())
    wanted = events.filter(in_interval(time_col, period)).join(
        dates, F.col(time_col).cast("date") == F.col("_dt"), "left_semi"
    )
    return operator(wanted)


def _file_stats(spark: SparkSession, directories: list[str]) -> dict:
    """(files, bytes) per `dt` partition of the given directories, from their listing.

    One row per date comes back.
    """
    dt = F.regexp_extract("path", r"/dt=(\d{4}-\d{2}-\d{2})/", 1).try_cast("date")
    stats = (
        list_files(spark, directories)
        .groupBy(dt.alias("dt"))
        .agg(F.count(F.lit(1)).alias("files"), F.sum("size").cast("bigint").alias("bytes"))
    )
    return {r.dt: r for r in stats.collect()}


def compact(
    spark: SparkSession,
    src: str,
    dst: str,
    dates: list[str],
    target_bytes: int = TARGET_FILE_BYTES,
    time_col: str = "created_at",
) -> DataFrame:
    """Merge the files of each date into about bytes / target_bytes files; returns the manifest.

    All dates are rewritten by one job. A date's rows are cut by time into files of about
    equally many rows: their seconds are counted first, and the running count tells the file
    of a second, or the files, if a second has more rows than one gets. Files of one date so
    follow one another in time, and each is sorted. A date is
    published only if its row count is unchanged; dates without input are skipped. The
    manifest has one row per date found in `src`.
    """
    started = datetime.now(timezone.utc)
    staged = storage.beside(dst, f"compacting-{started:%Y%m%dT%H%M%S%f}")
    wanted = [f"dt={d}" for d in sorted(set(dates))]
    sources = [f"{src.rstrip('/')}/{d}" for d in storage.present(spark, src, wanted)]
    plan = _file_stats(spark, sources) if sources else {}
    manifest_schema = (
        "compaction_date DATE, started_at TIMESTAMP, completed_at TIMESTAMP,"
        " files_before BIGINT, files_after BIGINT, rows_before BIGINT, rows_after BIGINT,"
        " status STRING"
    )
    if not plan:
        return spark.createDataFrame([], manifest_schema)

    sizes, total = [], 0
    for dt in sorted(plan):
        files = max(-(-plan[dt].bytes // target_bytes), 1)
        sizes.append((dt, total, files))
        total += files
    files_of = spark.createDataFrame(sizes, "dt DATE, first_file LONG, files LONG")

    def read(root: str) -> DataFrame:
        parts = [f"dt={dt.isoformat()}" for dt in sorted(plan)]
        present = [f"{root.rstrip('/')}/{d}" for d in storage.present(spark, root, parts)]
        return spark.read.option("basePath", root).parquet(*present)

    bronze = read(src)
    columns = bronze.columns
    second = F.coalesce(F.unix_seconds(time_col), F.lit(0))
    counted = bronze.groupBy("dt", second.alias("_second")).agg(F.count(F.lit(1)).alias("_n"))
    by_time = Window.partitionBy("dt").orderBy("_second")
    before_it = F.sum("_n").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    of_date = F.sum("_n").over(Window.partitionBy("dt"))
    slots = counted.select(
        "dt", "_second", "_n", F.coalesce(before_it, F.lit(0)).alias("_before"), of_date.alias("_all")
    ).join(files_of, "dt")
    share = F.col("files") / F.col("_all")
    first = F.floor(F.col("_before") * share)
    # A second with more rows than a file gets is dealt over the files it fills.
    span = F.greatest(F.lit(1), F.least(F.ceil(F.col("_n") * share), F.col("files") - first))
    slots = slots.select(
        "dt", "_second", (F.col("first_file") + first).alias("_first"), span.alias("_span")
    )
    row = F.xxhash64(*(c for c in columns if c != "dt"))
    (
        bronze.withColumn("_second", second)
        .join(slots, ["dt", "_second"])
        .withColumn("_slot", (F.col("_first") + F.pmod(row, F.col("_span"))).cast("int"))
        .select(*columns, "_slot")
        .repartitionById(total, F.col("_slot"))
        .sortWithinPartitions("dt", time_col)
        .drop("_slot")
        .write.mode("overwrite")
        .partitionBy("dt")
        .parquet(staged)
    )

    def rows_per_date(root: str) -> dict:
        return {r.dt: r["count"] for r in read(root).groupBy("dt").count().collect()}

    before, after = rows_per_date(src), rows_per_date(staged)
    files_after = {dt: r.files for dt, r in _file_stats(spark, [staged]).items()}
    complete = {dt: before.get(dt, 0) == after.get(dt, 0) for dt in plan}

    def publish(dt) -> None:
        directory = f"dt={dt.isoformat()}"
        storage.swap_in(spark, f"{staged}/{directory}", f"{dst.rstrip('/')}/{directory}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(publish, [dt for dt in plan if complete[dt] and after.get(dt)]))
    manifest = []
    for dt in sorted(plan):
        manifest.append(
            (
                dt,
                started,
                datetime.now(timezone.utc),
                plan[dt].files,
                files_after.get(dt, 0),
                before.get(dt, 0),
                after.get(dt, 0),
                "complete" if complete[dt] else "failed",
            )
        )
    storage.delete(spark, staged)
    return spark.createDataFrame(manifest, manifest_schema)
