"""Event stream and dead-letter sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import DLQ_MESSAGES
from tidemark.sources.offsets import (
    message_bounds,
    offset_options,
    topic_bounds,
    within_offsets,
)


def kafka_stream_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **extra,
    }


def kafka_batch_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
        **extra,
    }


def read_event_stream(
    spark: SparkSession, source: str, schema: T.StructType | None = None, **opts: str
) -> DataFrame:
    """Streaming DataFrame from Kafka or from a directory of files.

    `source="kafka"` needs `servers` and `topic`. File formats need `path` and a
    schema, and give the same columns as Kafka when the files hold `value` and
    `timestamp`.
    """
    if source == "kafka":
        options = kafka_stream_options(opts.pop("servers"), opts.pop("topic"), **opts)
        return spark.readStream.format("kafka").options(**options).load()
    path = opts.pop("path")
    return spark.readStream.format(source).schema(schema).options(**opts).load(path)


def read_dlq(
    spark: SparkSession,
    source: str,
    max_messages: int | None = None,
    plan: list[Row] | None = None,
    **opts: str,
) -> DataFrame:
    """Dead-letter messages (partition, offset, value), oldest first up to `max_messages`.

    By default the whole backlog. With a `plan` (see `sources.offsets`), only its ranges: Kafka
    is given them as its starting and ending offsets, so the rest of the topic is not read. A
    read bounded by `max_messages` alone is a top-k over (partition, offset), so each task
    keeps that many rows.
    """
    if source == "kafka":
        topic = opts.pop("topic")
        ranges = {} if plan is None else offset_options(plan, topic)
        options = kafka_batch_options(opts.pop("servers"), topic, **{**opts, **ranges})
        messages = _dlq_columns(spark.read.format("kafka").options(**options).load())
    else:
        messages = _stored_dlq(spark, source, **opts)
        if plan is not None:
            messages = within_offsets(messages, plan)
    return first_messages(messages, max_messages)


def dlq_bounds(spark: SparkSession, source: str, **opts: str) -> DataFrame:
    """(partition, earliest, latest) of the dead letters."""
    if source == "kafka":
        return topic_bounds(spark, **opts)
    return message_bounds(_stored_dlq(spark, source, **opts))


def _stored_dlq(spark: SparkSession, source: str, path: str, **opts: str) -> DataFrame:
    return _dlq_columns(spark.read.format(source).schema(DLQ_MESSAGES).options(**opts).load(path))


def _dlq_columns(raw: DataFrame) -> DataFrame:
    return raw.select("partition", "offset", F.col("value").cast("string").alias("value"))


def first_messages(messages: DataFrame, max_messages: int | None) -> DataFrame:
    if max_messages is None:
        return messages
    return messages.orderBy("partition", "offset").limit(max_messages)
