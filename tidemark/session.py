"""Session construction and the shared scratch location."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Hours, days and weeks are always UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rewriting an interval must leave the other partitions alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str, **conf: str) -> SparkSession:
    """Session with the engine's settings; `conf` keys win over them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new directory below the cluster's shared checkpoint folder.

    Without that setting, it is below the warehouse; a warehouse on a local file system will
    do only where driver and executors are one machine. The folder of an application can go
    once its results are written: see `drop_scratch`.
    """
    root = _scratch_root(spark)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        master = spark.sparkContext.master
        if root.startswith(("file:", "/")) and not (master == "local" or master.startswith("local[")):
            raise ValueError(
                f"set spark.checkpoint.dir to a folder that all machines share: {root} is local"
            )
        root = f"{root}/_scratch"
    return f"{root.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has put into the shared folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
