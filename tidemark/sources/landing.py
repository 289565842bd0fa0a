"""Scans of event data in the lake."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.intervals import Interval, in_interval
from tidemark.layout import DAILY, HOURLY, Layout
from tidemark.schemas import EVENTS, TENANT_GOLD
from tidemark.sinks import storage
from tidemark.sinks.tables import read_or_empty


def with_partitions(schema: T.StructType, layout: Layout) -> T.StructType:
    kinds = {"dt": T.DateType()}
    extra = [T.StructField(c, kinds.get(c, T.IntegerType())) for c in layout.columns]
    return T.StructType(schema.fields + extra)


def read_landing(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENTS,
    iv: Interval | None = None,
    tenants: list[str] | None = None,
    time_col: str = "created_at",
    layout: Layout | None = None,
) -> DataFrame:
    """Event files with an imposed schema.

    An interval becomes a partition predicate and a row filter, and only the days
    it touches are listed. With `tenants`, the table has a
    leading `tenant` partition and only those tenants are read, in one scan.
    The layout is by hour, and for tenants the one that is found.
    PLAIN_HOURS reads a tree whose directories carry no column names.
    """
    if layout is None:
        layout = HOURLY if tenants is None else tenant_layout(spark, path)
    full = with_partitions(schema, layout)
    if tenants is not None:
        full = T.StructType(full.fields + [T.StructField("tenant", T.StringType())])
    df = _read_directories(spark, path, full, layout, iv, tenants)
    if iv is not None:
        df = df.filter(layout.covers(iv) & in_interval(time_col, iv))
    if tenants is not None:
        df = df.filter(F.col("tenant").isin(list(tenants)))
    return df.drop(*layout.columns)


def read_hours(
    spark: SparkSession, path: str, hours: list[datetime], schema: T.StructType = EVENTS
) -> DataFrame:
    """Rows of single hours of a landing; no other directory is listed."""
    root = path.rstrip("/")
    wanted = [d for h in hours for d in HOURLY.directories((h, h + timedelta(hours=1)))]
    present = storage.present(spark, root, wanted) if storage.exists(spark, root) else []
    if not present:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(with_partitions(schema, HOURLY)).option("basePath", root)
    return reader.parquet(*(f"{root}/{d}" for d in present)).drop(*HOURLY.columns)


def tenant_layout(spark: SparkSession, path: str) -> Layout:
    """How the tenants of a landing are partitioned: by day, or by hour as before that.

    A tenant of a thousand with an hour's directory each would be mostly tiny files.
    """
    for tenant in sorted(storage.children(spark, path)):
        below = storage.children(spark, f"{path.rstrip('/')}/{tenant}")
        if any(d.startswith("year=") for d in below):
            return HOURLY
        if any(d.startswith("dt=") for d in below):
            return DAILY
    return DAILY


def _read_directories(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    layout: Layout,
    iv: Interval | None,
    tenants: list[str] | None,
) -> DataFrame:
    """The table, listing nothing but the days of the interval, found by their parents."""
    root = path.rstrip("/")
    present = [root] if storage.exists(spark, root) else []
    if present and iv is not None:
        days = dict.fromkeys(
            d.rpartition("/")[0] if "/" in d else d for d in layout.directories(iv)
        )
        prefixes = [f"tenant={t}/" for t in tenants] if tenants is not None else [""]
        wanted = [f"{prefix}{d}" for prefix in prefixes for d in days]
        present = [f"{root}/{d}" for d in storage.present(spark, root, wanted)]
    if not present:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if layout.columns:
        reader = reader.option("basePath", root)
    else:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(*present)


def read_tenant_gold(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """Column-pruned tenant gold; manifest tenants without rows appear once with zeros.

    A table that was never written counts as empty.
    """
    return with_manifest_tenants(read_or_empty(spark, path, TENANT_GOLD), manifest)


def with_manifest_tenants(gold: DataFrame, manifest: DataFrame) -> DataFrame:
    tenants = manifest.select(F.col("client_id").alias("tenant_id")).distinct()
    return tenants.join(gold, "tenant_id", "left").withColumn(
        "total_conversions", F.coalesce("total_conversions", F.lit(0).cast("bigint"))
    )
