"""Canonical inputs derived from the driver's tables, with deterministic defects.

The tables have no NULLs, duplicates or malformed text, so the inputs inject
them by id. Every row of the source table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.intervals import Interval, bucket_start, spine
from tidemark.session import use_utc
from tidemark.streaming.metrics import minute_counts

NULL_USER_EVERY = 37
COPY_EVERY = 50
COPY_ID_OFFSET = 10_000_000
MESSY_AMOUNT_EVERY = 41
TENANTS = 3

EVENTS_FILE = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
CUSTOMER_FILE = "c_custkey BIGINT, c_name STRING"
ORDERS_FILE = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING,"
    " o_orderdate TIMESTAMP, o_orderpriority STRING"
)


def table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    """A table with an imposed schema, which reads its time columns as TIMESTAMP."""
    use_utc(spark)
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def events_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events", EVENTS_FILE)


def _every(n: int, remainder: int = 0) -> Column:
    return F.pmod(F.col("event_id"), F.lit(n)) == remainder


def raw_events(
    spark: SparkSession,
    sf_dir: str,
    null_users: bool = False,
    copies: bool = False,
    messy_amounts: bool = False,
) -> DataFrame:
    """Canonical events. Copies get a higher id and are otherwise equal."""
    df = events_file(spark, sf_dir)
    amount = F.col("value").cast("decimal(12,2)")
    product = F.get_json_object("props", "$.k")
    user = F.col("user_id").cast("string")
    if null_users:
        user = F.when(~_every(NULL_USER_EVERY), user)
    shown = amount.cast("string")
    if messy_amounts:
        shown = (
            F.when(_every(MESSY_AMOUNT_EVERY, 0), F.lit('"1.2.3"'))
            .when(_every(MESSY_AMOUNT_EVERY, 1), F.lit("null"))
            .when(_every(MESSY_AMOUNT_EVERY, 2), F.lit('"abc"'))
            .otherwise(shown)
        )
    ids = F.array("event_id")
    if copies:
        ids = F.when(
            _every(COPY_EVERY), F.array("event_id", F.col("event_id") + COPY_ID_OFFSET)
        ).otherwise(ids)
    built = df.select(
        F.col("event_id"),
        user.alias("user_id"),
        "event_type",
        F.concat(
            F.lit('{"product_id": '), product, F.lit(', "amount": '), shown, F.lit("}")
        ).alias("payload"),
        product.cast("int").alias("product_id"),
        amount.alias("amount"),
        F.col("ts").alias("created_at"),
        ids.alias("_ids"),
    )
    if not copies:
        return built.drop("_ids").withColumnRenamed("event_id", "id")
    rest = [c for c in built.columns if c not in ("_ids", "event_id")]
    return built.select(F.explode("_ids").alias("id"), *rest)


def tenant_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    tenant = F.concat(F.lit("t"), F.pmod(F.col("user_id").cast("bigint"), F.lit(TENANTS)))
    return raw_events(spark, sf_dir).withColumn("tenant", tenant)


def manifest(spark: SparkSession, extra_tenant: bool = False) -> DataFrame:
    """Tenants t0, t1, ... with 7, 14 and 30 days; optionally one that has no events."""
    rows = spark.range(TENANTS + (1 if extra_tenant else 0))
    name = F.concat(F.lit("t"), F.col("id"))
    days = F.element_at(F.array(F.lit(7), F.lit(14), F.lit(30), F.lit(30)), (F.col("id") + 1).cast("int"))
    return rows.select(
        name.alias("client_id"),
        F.concat(F.lit("analytics_"), name).alias("target_table"),
        days.alias("retention_days"),
        F.col("id").cast("int").alias("position"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users; the sign-up time is the first order."""
    first = (
        table(spark, sf_dir, "orders", ORDERS_FILE)
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("_first"))
    )
    customers = table(spark, sf_dir, "customer", CUSTOMER_FILE)
    signup = F.coalesce("_first", F.lit("1995-01-01").cast("timestamp"))
    return customers.join(first, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("email"),
        signup.alias("created_at"),
        F.when(
            F.pmod(F.col("c_custkey"), F.lit(11)) == 0, F.date_add(signup, 30).cast("timestamp")
        ).alias("deleted_at"),
    )


def ingestion_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of type error; the product number selects the kind of error."""
    kinds = ["schema_error", "timeout", "rate_limit", "auth_error"]
    kind = F.element_at(
        F.array(*[F.lit(k) for k in kinds]), F.pmod(F.col("product_id"), F.lit(4)) + 1
    )
    errors = raw_events(spark, sf_dir).filter(F.col("event_type") == "error")
    return errors.select(
        "id",
        kind.alias("error_type"),
        F.col("payload").alias("raw_payload"),
        F.col("created_at").alias("occurred_at"),
    )


def task_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders", ORDERS_FILE).select(
        F.col("o_orderpriority").alias("dag_id"),
        F.concat(F.lit("task_"), F.pmod("o_custkey", F.lit(7))).alias("task_id"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("success").alias("state"),
        F.col("o_orderdate").alias("start_date"),
        F.col("o_orderkey").alias("try_number"),
    )


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four partitions; the last purchase stands for the committed position."""
    return (
        events_file(spark, sf_dir)
        .groupBy(F.pmod("user_id", F.lit(4)).cast("int").alias("partition"))
        .agg(
            F.max(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias(
                "committed_offset"
            ),
            F.max("event_id").alias("end_offset"),
        )
        .select(
            F.lit("metrics").alias("consumer_group"),
            F.concat(F.lit("topic_"), F.pmod("partition", F.lit(2))).alias("topic"),
            "partition",
            "committed_offset",
            "end_offset",
        )
    )


def health_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.get_json_object("props", "$.k").cast("int")
    return events_file(spark, sf_dir).select(
        F.col("event_type").alias("component"),
        F.col("ts").alias("check_time"),
        (F.pmod(product, F.lit(10)) != 0).alias("reachable"),
        F.pmod(product, F.lit(3)).cast("int").alias("alive_workers"),
    )


def _repeated_type(first: Column, last: Column) -> Column:
    parts = ['{"event_type": "', first, '", "user_id": "', F.col("user_id"), '", "event_type": "', last, '"}']
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue messages of the events, damaged by id: cut off, without user, an array,
    followed by text, already complete, or with the event type twice."""
    intact = F.concat(
        F.lit('{"user_id": "'),
        F.col("user_id"),
        F.lit('", "event_type": "'),
        F.col("event_type"),
        F.lit('", "nested": '),
        F.col("props"),
        F.lit("}"),
    )
    value = (
        F.when(_every(10, 0), F.concat(F.lit('{"user_id": "'), F.col("user_id")))
        .when(
            _every(10, 1),
            F.concat(F.lit('{"event_type": "'), F.col("event_type"), F.lit('"}')),
        )
        .when(_every(10, 2), F.lit("[1]"))
        .when(_every(10, 3), F.concat(intact, F.lit(' {"again": 1}')))
        .when(
            _every(10, 4),
            F.concat(
                F.lit('{"user_id": null, "event_type": "'),
                F.col("event_type"),
                F.lit('", "product_id": 5, "timestamp": "2024-01-01T00:00:00"}'),
            ),
        )
        .when(_every(10, 5), _repeated_type(F.lit("bad"), F.col("event_type")))
        .when(_every(10, 6), _repeated_type(F.col("event_type"), F.lit("bad")))
        .otherwise(intact)
    )
    return events_file(spark, sf_dir).select(
        F.pmod("event_id", F.lit(4)).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"),
        value.alias("value"),
        F.col("ts").alias("timestamp"),
    )


def minute_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute windows as the stream leaves them; recorded when the window closes."""
    counts = minute_counts(raw_events(spark, sf_dir), time_col="created_at")
    return counts.withColumn("recorded_at", F.col("window_end"))


def run_log(spark: SparkSession, sf_dir: str, iv: Interval) -> DataFrame:
    """Hourly row counts per tenant, hours without events included."""
    names = F.array(*[F.lit(f"t{i}") for i in range(TENANTS)])
    hours = spine(spark, iv, "1 hour", "interval_start")
    zeros = hours.select(F.explode(names).alias("pipeline"), "interval_start", F.lit(0).alias("_n"))
    ones = tenant_events(spark, sf_dir).select(
        F.col("tenant").alias("pipeline"),
        bucket_start("created_at", "1 hour").alias("interval_start"),
        F.lit(1).alias("_n"),
    )
    return (
        ones.unionByName(zeros)
        .groupBy("pipeline", "interval_start")
        .agg(F.sum("_n").cast("bigint").alias("row_count"))
        .withColumn("run_date", F.col("interval_start").cast("date"))
    )
