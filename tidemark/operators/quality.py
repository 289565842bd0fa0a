"""Null gates, allowed values, row-count SLAs and promotion of clean records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.intervals import (
    Interval,
    bucket_end,
    bucket_start,
    in_interval,
    spine,
)
from tidemark.functions.numbers import any_null, pct2, sum_long
from tidemark.operators.duplicates import deduplicate

NULL_RATE_THRESHOLD_PCT = 5.0
MIN_ROWS_PER_WINDOW = 10


def drop_nulls(df: DataFrame, cols: list[str]) -> tuple[DataFrame, Observation]:
    """Rows without a NULL in `cols`, and a count of all and of dropped rows.

    The counts are taken while the result is computed; there is no second scan.
    They are available from the observation after the first action.
    """
    counts = Observation()
    observed = df.observe(
        counts,
        F.count(F.lit(1)).alias("total"),
        F.count_if(any_null(cols)).alias("dropped"),
    )
    return observed.dropna(subset=list(cols)), counts


def keep_allowed(df: DataFrame, col: str, allowed: list[str]) -> DataFrame:
    """Rows whose value is in the allowed set; NULL is dropped."""
    return df.filter(F.col(col).isin(list(allowed)))


def _counts_per_bucket(
    events: DataFrame, iv: Interval | None, every: str, time_col: str, *aggs
) -> DataFrame:
    """Aggregates per bucket; with an interval, empty buckets appear as well.

    Spine rows carry weight 0 and go through the same aggregation as the events,
    which needs one shuffle of pre-aggregated rows and no join.
    """
    if iv is not None:
        events = events.filter(in_interval(time_col, iv))
    rows = events.withColumns(
        {"window_start": bucket_start(time_col, every), "_weight": F.lit(1)}
    )
    if iv is not None:
        empty = spine(events.sparkSession, iv, every).withColumn("_weight", F.lit(0))
        rows = rows.unionByName(empty, allowMissingColumns=True)
    return rows.groupBy("window_start").agg(*aggs)


def null_rate(
    events: DataFrame,
    cols: tuple[str, ...] = ("user_id", "payload"),
    every: str = "1 hour",
    iv: Interval | None = None,
    time_col: str = "created_at",
    threshold: float = NULL_RATE_THRESHOLD_PCT,
) -> DataFrame:
    """Share of rows with a NULL in `cols` per bucket, and the gate decision.

    A bucket is quarantined if the exact share reaches the threshold. Empty
    buckets have a rate of 0 and pass.
    """
    return (
        _counts_per_bucket(
            events,
            iv,
            every,
            time_col,
            sum_long("_weight").alias("total_rows"),
            F.count_if(any_null(list(cols)) & (F.col("_weight") == 1)).alias("null_rows"),
        )
        .select(
            "window_start",
            bucket_end("window_start", every).alias("window_end"),
            "total_rows",
            "null_rows",
            F.coalesce(pct2("null_rows", "total_rows"), F.lit(0.0)).alias("null_pct"),
            (
                (F.col("total_rows") > 0)
                & (F.col("null_rows") * F.lit(100.0) >= F.col("total_rows") * F.lit(threshold))
            ).alias("quarantine"),
        )
    )


def null_quarantine(
    events: DataFrame,
    cols: tuple[str, ...] = ("user_id", "payload"),
    every: str = "1 hour",
    threshold: float = NULL_RATE_THRESHOLD_PCT,
    iv: Interval | None = None,
    time_col: str = "created_at",
    id_col: str = "id",
    reason: str = "null_user_id_or_payload",
) -> DataFrame:
    """The offending rows of every bucket that fails the null gate.

    Only rows with NULLs take part in the join back to the failing buckets; the
    runtime chooses the join by the measured size of the aggregate.
    """
    failing = null_rate(events, cols, every, iv, time_col, threshold).filter("quarantine")
    failing = failing.select("window_start", "window_end")
    if iv is not None:
        events = events.filter(in_interval(time_col, iv))
    bad = events.filter(any_null(list(cols))).select(
        F.col(id_col).alias("event_id"), bucket_start(time_col, every).alias("window_start")
    )
    return bad.join(failing, "window_start").select(
        "event_id", "window_start", "window_end", F.lit(reason).alias("reason")
    )


def row_count_sla(
    events: DataFrame,
    iv: Interval,
    every: str = "1 hour",
    min_rows: int = MIN_ROWS_PER_WINDOW,
    time_col: str = "created_at",
) -> DataFrame:
    """Row count of every bucket of the interval; passes and failures are both reported."""
    return _counts_per_bucket(
        events.select(time_col), iv, every, time_col, sum_long("_weight").alias("row_count")
    ).select(
        "window_start", "row_count", (F.col("row_count") >= min_rows).alias("sla_passed")
    )


def promote_to_bronze(
    landing: DataFrame,
    required: tuple[str, ...] = ("user_id", "event_type", "created_at"),
    allowed: tuple[str, ...] | None = None,
    keys: tuple[str, ...] = ("user_id", "event_type"),
) -> DataFrame:
    """Validated events: required columns present, type allowed, first of each duplicate group."""
    clean = landing.dropna(subset=list(required))
    if allowed is not None:
        clean = keep_allowed(clean, "event_type", list(allowed))
    return deduplicate(clean, keys)
