"""Per-tenant conversions and cross-tenant reports, all tenants in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.intervals import Moment, day, ts
from tidemark.functions.numbers import pct2, sum_long


def tenant_conversions(
    events: DataFrame,
    manifest: DataFrame,
    as_of: Moment,
    event_type: str | None = "purchase",
    tenant_col: str = "tenant",
    time_col: str = "created_at",
) -> DataFrame:
    """Conversions per tenant, product and type within each tenant's retention.

    Tenants outside the manifest are left out. No join hint: the manifest's size
    is known from its file, so the planner broadcasts it while it is small, and
    a hot tenant is split by the skew join otherwise. `event_type=None` counts
    all types.
    """
    if event_type is not None:
        events = events.filter(F.col("event_type") == event_type)
    cutoffs = manifest.select(
        F.col("client_id").alias("tenant_id"),
        (
            ts(as_of) - F.make_dt_interval(F.col("retention_days"))
        ).alias("_cutoff"),
    )
    return (
        events.filter(F.col(time_col) < ts(as_of))
        .withColumnRenamed(tenant_col, "tenant_id")
        .join(cutoffs, "tenant_id")
        .filter(F.col(time_col) >= F.col("_cutoff"))
        .groupBy("tenant_id", "product_id", "event_type")
        .agg(F.count(F.lit(1)).alias("total_conversions"))
        .select("product_id", "event_type", "total_conversions", "tenant_id")
    )


def tenant_totals(tenant_gold: DataFrame, manifest: DataFrame) -> DataFrame:
    """Events, purchases and purchase rate of every manifest tenant, zeros included.

    Gold is reduced to one row per tenant before it meets the manifest.
    """
    totals = tenant_gold.groupBy("tenant_id").agg(
        sum_long("total_conversions").alias("_events"),
        sum_long(
            F.when(F.col("event_type") == "purchase", F.col("total_conversions"))
        ).alias("_purchases"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        manifest.select(F.col("client_id").alias("tenant_id"), "position")
        .join(totals, "tenant_id", "left")
        .select(
            "tenant_id",
            "position",
            F.coalesce("_events", zero).alias("event_count"),
            F.coalesce("_purchases", zero).alias("purchase_count"),
        )
        .withColumn(
            "purchase_rate", F.coalesce(pct2("purchase_count", "event_count"), F.lit(0.0))
        )
    )


def tenant_ranking(tenant_gold: DataFrame, manifest: DataFrame) -> DataFrame:
    """Tenants by event count; equal counts keep the order of the manifest."""
    order = Window.partitionBy().orderBy(F.desc("event_count"), "position")
    return tenant_totals(tenant_gold, manifest).select(
        F.row_number().over(order).alias("rank"),
        "tenant_id",
        "event_count",
        "purchase_count",
        "purchase_rate",
    )


def cross_tenant_comparison(
    tenant_gold: DataFrame, manifest: DataFrame, report_week: Moment
) -> DataFrame:
    """One report row: the top tenant and the whole ranking as JSON.

    The ranking has one entry per manifest tenant.
    """
    entry = F.struct(
        "rank", F.col("tenant_id").alias("tenant"), "event_count", "purchase_count", "purchase_rate"
    )
    ranked = F.array_sort(F.collect_list(entry))
    return (
        tenant_ranking(tenant_gold, manifest)
        .agg(ranked.alias("_tenants"))
        .select(
            day(report_week).alias("report_week"),
            F.coalesce(F.get("_tenants", F.lit(0))["tenant"], F.lit("none")).alias("top_tenant"),
            F.to_json(
                F.struct(
                    day(report_week).cast("string").alias("report_week"),
                    F.col("_tenants").alias("tenants"),
                )
            ).alias("details"),
        )
    )


def batch_tenant_join(batch_gold: DataFrame, tenant_gold: DataFrame) -> DataFrame:
    """Batch and tenant conversions side by side per product, absent counts as 0.

    Both inputs go through one aggregation on product_id, which is the full outer
    join of the two totals and also pairs the NULL products of both sides.
    """
    batch = batch_gold.select(
        "product_id",
        F.col("total_conversions").alias("_batch"),
        F.lit(0).cast("bigint").alias("_tenant"),
    )
    tenant = tenant_gold.select(
        "product_id",
        F.lit(0).cast("bigint").alias("_batch"),
        F.col("total_conversions").alias("_tenant"),
    )
    return (
        batch.unionByName(tenant)
        .groupBy("product_id")
        .agg(
            sum_long("_batch").alias("batch_conversions"),
            sum_long("_tenant").alias("tenant_conversions"),
        )
        .withColumn("tenant_share", pct2("tenant_conversions", "batch_conversions"))
    )
