"""Parallel JDBC reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.intervals import Interval, in_interval, moment


def jdbc_options(
    url: str,
    table: str,
    partition_col: str,
    lower: str,
    upper: str,
    num_partitions: int,
    **extra: str,
) -> dict[str, str]:
    """Reader options for a read that is split on one numeric or time column."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": partition_col,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(num_partitions),
        **extra,
    }


def read_table_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_col: str,
    lower: str,
    upper: str,
    num_partitions: int,
    **extra: str,
) -> DataFrame:
    options = jdbc_options(url, table, partition_col, lower, upper, num_partitions, **extra)
    return spark.read.format("jdbc").options(**options).load()


def read_events_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    iv: Interval,
    partition_col: str = "created_at",
    num_partitions: int = 32,
    **extra: str,
) -> DataFrame:
    """Events of one interval, each task reading its own time slice.

    The interval filter is pushed to the database; rows are not sorted globally,
    because the landing write orders them within its files.
    """
    start, end = (moment(m).isoformat(sep=" ") for m in iv)
    df = read_table_jdbc(spark, url, table, partition_col, start, end, num_partitions, **extra)
    return df.filter(in_interval(partition_col, iv))
