"""Archives, reports and outgoing messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.intervals import Moment, day, ts
from tidemark.sinks.tables import append_absent


def archive_rows(df: DataFrame, as_of: Moment, reason: str) -> DataFrame:
    return df.withColumns(
        {
            "archived_at": ts(as_of),
            "archive_reason": F.lit(reason),
            "archive_date": day(as_of),
        }
    )


def archive(df: DataFrame, path: str, as_of: Moment, reason: str) -> None:
    """Dated archive. Running a date again adds the users it lacks and drops none."""
    append_absent(
        archive_rows(df, as_of, reason),
        path,
        ("archive_date", "user_id"),
        ("archive_date",),
        scope=F.col("archive_date") == day(as_of),
    )


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header. A report fits one file; a large result is split by size."""
    df.hint("rebalance").write.mode("overwrite").option("header", True).csv(path)


def message_values(df: DataFrame) -> DataFrame:
    """Rows as JSON text in a `value` column, NULL fields included."""
    return df.select(
        F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    )


def replayed(messages: DataFrame, topic: str | None = None) -> DataFrame:
    """Repaired dead letters as messages: their text, the user as key, and where they were.

    The key brings a user's messages to one partition again. The headers name the partition and
    offset of the dead letter, by which a consumer can tell a message that was replayed twice.
    """
    header = [
        F.struct(F.lit(name).alias("key"), F.encode(F.col(c).cast("string"), "UTF-8").alias("value"))
        for name, c in (("dlq_partition", "partition"), ("dlq_offset", "offset"))
    ]
    user = F.coalesce(*(F.get_json_object("fixed_value", f"$.{k}") for k in ("user_id", "userId")))
    rows = messages.select(
        user.alias("key"), F.col("fixed_value").alias("value"), F.array(*header).alias("headers")
    )
    return rows if topic is None else rows.withColumn("topic", F.lit(topic))


def kafka_sink_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    """Options of a write that waits for all replicas and carries headers."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "includeHeaders": "true",
        **extra,
    }


def republish(messages: DataFrame, sink: str, **opts: str) -> None:
    """Send messages to Kafka or, as further text files of their values, to a directory.

    Kafka gets `key` and `headers` as well where there are such columns.
    """
    if sink == "kafka":
        fields = [c for c in ("key", "value", "headers") if c in messages.columns]
        options = kafka_sink_options(**opts)
        messages.select(*fields).write.format("kafka").options(**options).save()
    else:
        messages.select("value").write.mode("append").text(opts["path"])


def jdbc_append(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append to a JDBC table; the connection count is the partition count of `df`."""
    df.write.jdbc(url=url, table=table, mode="append", properties=properties)
