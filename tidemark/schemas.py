"""Declared schemas (fixed column names and types) and the mapping of raw layouts to events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.numbers import safe_amount, safe_cast


INT, LONG, TEXT, FLAG = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()
DATE, TIME = T.DateType(), T.TimestampType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Canonical event. product_id and amount are lifted out of the payload once, at
# ingestion, so that aggregations never have to read or parse the JSON column.
EVENTS = _schema(
    id=LONG,
    user_id=TEXT,
    event_type=TEXT,
    payload=TEXT,
    product_id=INT,
    # Wide enough to keep any amount of a payload as it is.
    amount=T.DecimalType(24, 8),
    created_at=TIME,
)

# Extracted rows as they arrive, before the payload is read.
LANDING_RAW = _schema(
    id=LONG,
    user_id=TEXT,
    event_type=TEXT,
    payload=TEXT,
    created_at=TIME,
)
LANDING_FLAT = _schema(
    id=TEXT,
    user_id=TEXT,
    event_type=TEXT,
    product_id=INT,
    created_at=TIME,
)

# Stream payload: both spellings of every field are accepted.
MESSAGE = _schema(
    userId=TEXT,
    eventType=TEXT,
    productId=INT,
    user_id=TEXT,
    event_type=TEXT,
    product_id=INT,
    timestamp=TIME,
)

USERS = _schema(
    user_id=TEXT,
    email=TEXT,
    created_at=TIME,
    deleted_at=TIME,
)
USER_COHORTS = _schema(
    user_id=TEXT,
    cohort_week=DATE,
)
LIVE_METRICS = _schema(
    window_start=TIME,
    window_end=TIME,
    event_type=TEXT,
    event_count=LONG,
    recorded_at=TIME,
)
TENANT_MANIFEST = _schema(
    client_id=TEXT,
    schedule=TEXT,
    target_table=TEXT,
    retention_days=INT,
)
TENANT_GOLD = _schema(
    product_id=INT,
    event_type=TEXT,
    total_conversions=LONG,
    tenant_id=TEXT,
)
INGESTION_ERRORS = _schema(
    id=LONG,
    error_type=TEXT,
    error_msg=TEXT,
    raw_payload=TEXT,
    occurred_at=TIME,
)
RUN_LOG = _schema(
    pipeline=TEXT,
    interval_start=TIME,
    row_count=LONG,
    mode=TEXT,
    passed_at=TIME,
)
TASK_RUNS = _schema(
    dag_id=TEXT,
    task_id=TEXT,
    state=TEXT,
    start_date=TIME,
    end_date=TIME,
    try_number=INT,
    max_tries=INT,
    hostname=TEXT,
)
OFFSETS = _schema(
    consumer_group=TEXT,
    topic=TEXT,
    partition=INT,
    committed_offset=LONG,
    end_offset=LONG,
)
HEALTH_READINGS = _schema(
    component=TEXT,
    check_time=TIME,
    reachable=FLAG,
    alive_workers=INT,
)
BACKFILLED = _schema(dt=DATE)
REPLAY_OFFSETS = _schema(
    partition=INT,
    next_offset=LONG,
)
# Changes of landing hours, the last one that a rollup has seen, and its counts.
CHANGES = _schema(hour_start=TIME, changed_at=TIME)
CHANGE_MARKS = _schema(dt=DATE, hour_start=TIME, changed_at=TIME)
HOURLY_COUNTS = _schema(
    hour_start=TIME,
    event_type=TEXT,
    total_count=LONG,
    avg_per_minute=T.DoubleType(),
    dt=DATE,
)
# Users by number, and the days whose sets of users are stored.
USER_NUMBERS = _schema(user_id=TEXT, number=LONG)
STORED_DAYS = _schema(report_date=DATE)
STREAM_PROGRESS = _schema(
    query_id=TEXT,
    run_id=TEXT,
    batch_id=LONG,
    triggered_at=TIME,
    input_rows=LONG,
    watermark=TIME,
    state_rows=LONG,
    rows_dropped_late=LONG,
    duration_ms=LONG,
)
# Counts of windows that a stream adds to, and the watermark after each of its batches.
WINDOW_TOTALS = _schema(
    window_date=DATE,
    window_start=TIME,
    event_type=TEXT,
    window_end=TIME,
    event_count=LONG,
    count_before=LONG,
    last_batch=TEXT,
)
LATE_MARKS = _schema(watermark=TIME)
OFFSET_PLAN = _schema(
    partition=INT,
    starting=LONG,
    ending=LONG,
    lost=LONG,
    status=TEXT,
)
DLQ_MESSAGES = _schema(
    partition=INT,
    offset=LONG,
    value=TEXT,
)


def normalise(df: DataFrame) -> DataFrame:
    """Project any of the raw event layouts onto EVENTS.

    Accepts rows with a JSON payload, flat rows with product_id, and rows whose
    time column is called `timestamp`.
    """
    have = set(df.columns)
    payload = F.col("payload") if "payload" in have else F.lit(None)
    source = {
        "payload": payload.cast("string"),
        "created_at": F.col("created_at" if "created_at" in have else "timestamp"),
        "product_id": F.col("product_id")
        if "product_id" in have
        else safe_cast(F.get_json_object(payload.cast("string"), "$.product_id"), "int"),
        "amount": F.col("amount")
        if "amount" in have
        else safe_amount(payload.cast("string"), "amount"),
    }
    return df.select(
        *[
            source.get(f.name, F.col(f.name) if f.name in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in EVENTS.fields
        ]
    )


def unread_amounts(df: DataFrame) -> DataFrame:
    """How many payload amounts are present, and how many of them are not a number that fits."""
    text = F.get_json_object(F.col("payload").cast("string"), "$.amount")
    return df.agg(
        F.count(text).alias("amounts"),
        F.count_if(text.isNotNull() & safe_amount("payload", "amount").isNull()).alias("unread"),
    )
