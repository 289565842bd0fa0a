"""Which offsets of a topic the next bounded read takes.

A plan has one row per partition of the topic: where the read starts and ends (exclusive), how
many messages retention has removed since the last read, and what the partition is:

- `new`: never read, taken from its earliest offset;
- `lagging`: read before, continued at its stored offset; `idle` if nothing came since;
- `gap`: messages behind the stored offset are gone, continued at the earliest one left;
- `reset`: the topic ends before the stored offset, so it was made anew; taken from its start;
- `vanished`: stored, but no longer part of the topic; nothing is read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.schemas import OFFSET_PLAN

_BYTES = "org.apache.kafka.common.serialization.ByteArrayDeserializer"


def message_bounds(messages: DataFrame) -> DataFrame:
    """(partition, earliest, latest) of stored messages; `latest` is the offset that comes next."""
    return messages.groupBy("partition").agg(
        F.min("offset").alias("earliest"), (F.max("offset") + 1).alias("latest")
    )


def topic_bounds(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """(partition, earliest, latest) of a topic, as its broker tells them; no message is read.

    `extra` are the connection's `kafka.` options. Needs the Kafka connector on the driver.
    """
    jvm = spark._jvm
    given = {k.removeprefix("kafka."): v for k, v in extra.items() if k.startswith("kafka.")}
    settings = {
        **given,
        "bootstrap.servers": servers,
        "key.deserializer": _BYTES,
        "value.deserializer": _BYTES,
    }
    properties = jvm.java.util.Properties()
    for key, value in settings.items():
        properties.put(key, value)
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(properties)
    try:
        parts = [
            jvm.org.apache.kafka.common.TopicPartition(topic, info.partition())
            for info in consumer.partitionsFor(topic)
        ]
        first, last = consumer.beginningOffsets(parts), consumer.endOffsets(parts)
        rows = [(p.partition(), int(first[p]), int(last[p])) for p in parts]
    finally:
        consumer.close()
    return spark.createDataFrame(rows, "partition INT, earliest BIGINT, latest BIGINT")


def plan_offsets(
    done: DataFrame, bounds: DataFrame, max_messages: int | None = None
) -> DataFrame:
    """The plan (partition, starting, ending, lost, status) of the next read.

    `done` has (partition, next_offset), `bounds` (partition, earliest, latest). With
    `max_messages`, ranges are taken in the order of the partitions until that many offsets
    are planned; later partitions wait for the next read. Both tables have one row per
    partition of the topic, which is what the running sum of the ranges passes through.
    """
    at, low, high = F.col("next_offset"), F.col("earliest"), F.col("latest")
    status = (
        F.when(high.isNull(), "vanished")
        .when(at.isNull(), "new")
        .when(at > high, "reset")
        .when(at < low, "gap")
        .when(at == high, "idle")
        .otherwise("lagging")
    )
    kept = F.col("status").isin("lagging", "idle", "vanished")
    start = F.when(kept, at).otherwise(low)
    planned = (
        done.join(bounds, "partition", "full")
        .withColumn("status", status)
        .withColumn("starting", start)
        .withColumn("lost", F.when(F.col("status") == "gap", low - at).otherwise(0))
        .withColumn("ending", F.coalesce(high, at))
    )
    if max_messages is not None:
        size = F.col("ending") - F.col("starting")
        before = F.sum(size).over(Window.orderBy("partition")) - size
        left = F.greatest(F.lit(0), F.lit(max_messages) - before)
        planned = planned.withColumn("ending", F.col("starting") + F.least(size, left))
    return planned.select(*(F.col(f.name).cast(f.dataType) for f in OFFSET_PLAN.fields))


def offset_options(plan: list[Row], topic: str) -> dict[str, str]:
    """The range options of a bounded Kafka read. The source wants every partition of the topic
    named, and none that it does not have."""
    known = sorted((r for r in plan if r.status != "vanished"), key=lambda r: r.partition)
    return {
        option: json.dumps({topic: {str(r.partition): r[column] for r in known}})
        for option, column in (("startingOffsets", "starting"), ("endingOffsets", "ending"))
    }


def within_offsets(messages: DataFrame, plan: list[Row]) -> DataFrame:
    """Stored messages of the planned ranges.

    The outermost offsets are a plain comparison, which prunes row groups; the ranges
    themselves, one row per partition of the topic, come from a join.
    """
    taken = [r for r in plan if r.starting < r.ending]
    if not taken:
        return messages.limit(0)
    low, high = min(r.starting for r in taken), max(r.ending for r in taken)
    ranges = messages.sparkSession.createDataFrame(
        [(r.partition, r.starting, r.ending) for r in taken],
        "partition INT, starting BIGINT, ending BIGINT",
    )
    near = messages.filter((F.col("offset") >= low) & (F.col("offset") < high))
    inside = (F.col("offset") >= F.col("starting")) & (F.col("offset") < F.col("ending"))
    return (
        near.join(F.broadcast(ranges), "partition").filter(inside).drop("starting", "ending")
    )


def offset_gaps(plan: DataFrame) -> DataFrame:
    """(partition, from_offset, to_offset, lost) of the messages that retention took unread."""
    return plan.filter("lost > 0").select(
        "partition",
        (F.col("starting") - F.col("lost")).alias("from_offset"),
        F.col("starting").alias("to_offset"),
        "lost",
    )


def reached_offsets(plan: DataFrame) -> DataFrame:
    """(partition, next_offset) after the planned ranges were read."""
    return plan.filter("status <> 'vanished'").select(
        "partition", F.col("ending").alias("next_offset")
    )
