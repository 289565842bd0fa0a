"""From raw messages to watermarked minute counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import MESSAGE

WINDOW = "1 minute"
WATERMARK = "2 minutes"


def decode_events(
    raw: DataFrame, schema: T.StructType = MESSAGE, time_col: str = "timestamp"
) -> DataFrame:
    """Parse the JSON value and keep the broker time as `kafka_ts`.

    Fields may be spelled in camel or snake case. Malformed values give NULL
    fields; the dead-letter split takes them out before this stage.
    """
    data = F.from_json(F.col("value").cast("string"), schema)
    parsed = raw.select(data.alias("data"), F.col(time_col).alias("kafka_ts"))
    return parsed.select(
        F.coalesce("data.userId", "data.user_id").alias("user_id"),
        F.coalesce("data.eventType", "data.event_type").alias("event_type"),
        F.coalesce("data.productId", "data.product_id").alias("product_id"),
        F.col("data.timestamp").alias("event_time"),
        "kafka_ts",
    )


def first_copies(
    events: DataFrame,
    keys: tuple[str, ...] = ("user_id", "event_type"),
    grain: str = "second",
    time_col: str = "kafka_ts",
    watermark: str = WATERMARK,
) -> DataFrame:
    """One event of each group that agrees on the keys and on the time cut to a grain.

    On a stream, a group is remembered until the watermark has passed its first event by the
    delay of `watermark`; a copy that comes within that time is dropped, also after a restart,
    and state does not grow beyond it. A NULL key equals another.
    """
    slotted = events.withColumn("_slot", F.date_trunc(grain, time_col))
    if events.isStreaming:
        timed = slotted.withWatermark(time_col, watermark)
        kept = timed.dropDuplicatesWithinWatermark([*keys, "_slot"])
    else:
        kept = slotted.dropDuplicates([*keys, "_slot"])
    return kept.drop("_slot")


def minute_counts(
    events: DataFrame,
    time_col: str = "kafka_ts",
    window: str = WINDOW,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    """Events per tumbling window and type; the same function for streams and tables.

    On a stream, rows later than the watermark are dropped from state and show up
    as `numRowsDroppedByWatermark` in the query progress. None leaves the watermark that
    `events` have already.
    """
    if events.isStreaming and watermark is not None:
        events = events.withWatermark(time_col, watermark)
    return (
        events.groupBy(F.window(time_col, window), "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "event_type",
            "event_count",
        )
    )


def dropped_by_watermark(progress: list) -> int:
    """Late rows over all state operators of a list of query progresses."""
    return sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators)
