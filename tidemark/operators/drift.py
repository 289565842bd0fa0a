"""Event-type distributions, their drift, and schema drift."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, Moment, bucket_start, day, in_interval, moment
from tidemark.functions.numbers import pct2, pct_hundredths

DRIFT_THRESHOLD_PCT = 10.0

# Expected columns of landing files, in Spark's notation (fixed values).
REFERENCE_SCHEMA = {
    "id": "bigint",
    "user_id": "string",
    "event_type": "string",
    "payload": "string",
    "created_at": "timestamp",
}


def type_distribution(
    events: DataFrame, iv: Interval, time_col: str = "created_at", type_col: str = "event_type"
) -> DataFrame:
    """Count and percentage per event type. The total is a window over the small aggregate."""
    return (
        events.filter(in_interval(time_col, iv))
        .groupBy(type_col)
        .agg(F.count(F.lit(1)).alias("cnt"))
        .withColumn("pct", pct2("cnt", F.sum("cnt").over(Window.partitionBy())))
    )


def distribution_drift(
    events: DataFrame,
    day_: Moment,
    baseline_days: int = 7,
    time_col: str = "created_at",
    type_col: str = "event_type",
) -> DataFrame:
    """Share per type on one day, pooled share over the days before, and their distance.

    Both periods are counted in one scan, so a type missing on one side simply
    has a count of 0 there. Distances are differences of hundredths of a percent
    and exact.
    """
    start = moment(day_)
    today = (start, start + timedelta(days=1))
    baseline = (start - timedelta(days=baseline_days), start)
    counts = (
        events.filter(in_interval(time_col, (baseline[0], today[1])))
        .groupBy(type_col)
        .agg(
            F.count_if(in_interval(time_col, today)).alias("today_count"),
            F.count_if(in_interval(time_col, baseline)).alias("baseline_count"),
        )
    )
    whole = Window.partitionBy()

    def share(c: str) -> Column:
        return F.coalesce(pct_hundredths(c, F.sum(c).over(whole)), F.lit(0).cast("bigint"))

    return (
        counts.withColumns({"_t": share("today_count"), "_b": share("baseline_count")})
        .select(
            F.col(type_col).alias("event_type"),
            "today_count",
            "baseline_count",
            (F.col("_t") / F.lit(100.0)).alias("today_pct"),
            (F.col("_b") / F.lit(100.0)).alias("baseline_pct"),
            (F.abs(F.col("_t") - F.col("_b")) / F.lit(100.0)).alias("deviation"),
        )
    )


def compare_distributions(today: DataFrame, baseline: DataFrame) -> DataFrame:
    """The same comparison for two stored distributions (event_type, pct)."""
    t = today.select("event_type", F.col("pct").alias("today_pct"))
    b = baseline.select("event_type", F.col("pct").alias("baseline_pct"))
    return (
        t.join(b, "event_type", "full_outer")
        .na.fill(0.0, ["today_pct", "baseline_pct"])
        .withColumn(
            "deviation",
            F.abs(
                F.round(F.col("today_pct") * 100).cast("bigint")
                - F.round(F.col("baseline_pct") * 100).cast("bigint")
            )
            / F.lit(100.0),
        )
    )


def _json_shares(value: str, count: str) -> Column:
    entry = F.struct(F.coalesce("event_type", F.lit("null")), F.col(value))
    entries = F.collect_list(F.when(F.col(count) > 0, entry))
    return F.to_json(F.map_from_entries(F.array_sort(entries)))


def drift_audit(
    drift: DataFrame, day_: Moment, threshold: float = DRIFT_THRESHOLD_PCT
) -> DataFrame:
    """One audit row: largest deviation, decision, and both distributions as JSON.

    No events on either side means a deviation of 0 and no drift.
    """
    return drift.agg(
        F.coalesce(F.max("deviation"), F.lit(0.0)).alias("max_deviation_pct"),
        _json_shares("today_pct", "today_count").alias("today_dist"),
        _json_shares("baseline_pct", "baseline_count").alias("baseline_dist"),
    ).select(
        day(day_).alias("report_date"),
        (F.col("max_deviation_pct") >= threshold).alias("drift_detected"),
        "max_deviation_pct",
        "today_dist",
        "baseline_dist",
    )


def schema_drift(actual: DataFrame, reference: DataFrame) -> DataFrame:
    """Column-wise comparison of two (col_name, data_type) tables; equal columns are left out."""
    a = actual.select("col_name", F.col("data_type").alias("actual_type"))
    r = reference.select("col_name", F.col("data_type").alias("expected_type"))
    status = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "extra")
        .when(F.col("actual_type") != F.col("expected_type"), "type_mismatch")
    )
    return (
        r.join(a, "col_name", "full_outer")
        .withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select("col_name", "status", "expected_type", "actual_type")
    )


def schema_drift_record(drift: DataFrame, as_of: Column) -> DataFrame:
    """One log row: flag, missing and extra columns, mismatches as JSON."""

    def named(status: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("status") == status, F.col("col_name"))))

    mismatch = F.when(
        F.col("status") == "type_mismatch",
        F.struct(
            F.col("col_name"),
            F.struct(F.col("expected_type").alias("expected"), F.col("actual_type").alias("actual")),
        ),
    )
    return drift.agg(
        (F.count(F.lit(1)) > 0).alias("drift_detected"),
        named("missing").alias("missing_cols"),
        named("extra").alias("extra_cols"),
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(mismatch)))).alias(
            "type_mismatches"
        ),
    ).withColumn("checked_at", as_of)


def payload_key_drift(
    events: DataFrame,
    reference_keys: tuple[str, ...],
    every: str = "1 day",
    time_col: str = "created_at",
    payload_col: str = "payload",
) -> DataFrame:
    """Presence of every payload key per bucket against the expected keys.

    One scan: each row yields its keys and a NULL marker that counts the row.
    After the first aggregation there is one row per bucket and key. The row
    totals come from an aggregation of that result, which reuses its shuffle, so
    a bucket with very many different keys is not gathered in one task.
    """
    keys = F.array_distinct(
        F.coalesce(F.json_object_keys(payload_col), F.array().cast("array<string>"))
    )
    marker = F.array(F.lit(None).cast("string"))
    counts = (
        events.select(
            bucket_start(time_col, every).alias("window_start"),
            F.explode(F.concat(marker, keys)).alias("_key"),
        )
        .groupBy("window_start", "_key")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    expected = F.array(*[F.lit(k) for k in reference_keys])
    entry = F.when(
        F.col("_key").isNull(),
        F.transform(
            expected, lambda k: F.struct(k.alias("key"), F.lit(0).cast("bigint").alias("n"))
        ),
    ).otherwise(F.array(F.struct(F.col("_key").alias("key"), F.col("_n").alias("n"))))
    totals = counts.groupBy(F.col("window_start").alias("_window")).agg(
        F.max(F.when(F.col("_key").isNull(), F.col("_n"))).alias("total_rows")
    )
    return (
        counts.join(totals, F.col("window_start").eqNullSafe(F.col("_window")))
        .select("window_start", "total_rows", F.explode(entry).alias("_e"))
        .groupBy("window_start", "total_rows", F.col("_e.key").alias("key"))
        .agg(F.sum("_e.n").cast("bigint").alias("present_rows"))
        .select(
            "window_start",
            "key",
            "present_rows",
            "total_rows",
            pct2("present_rows", "total_rows").alias("presence_pct"),
            F.when(~F.col("key").isin(list(reference_keys)), "extra")
            .when(F.col("present_rows") == 0, "missing")
            .when(F.col("present_rows") < F.col("total_rows"), "partial")
            .otherwise("ok")
            .alias("status"),
        )
    )
