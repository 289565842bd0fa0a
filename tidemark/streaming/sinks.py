"""Micro-batch sinks.

The Parquet sinks give the same table if a batch is repeated. A JDBC append cannot: its rows
carry their batch, so that a reader can take the last attempt.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.messages import STREAM_ALIASES, classify_messages
from tidemark.sinks.exports import jdbc_append
from tidemark.sinks.tables import upsert_table

TRIGGER = {"processingTime": "10 seconds"}
METRIC_KEYS = ("window_date", "window_start", "event_type")


def write_stream_upsert(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    keys: tuple[str, ...] = METRIC_KEYS,
    partition_cols: tuple[str, ...] = ("window_date",),
    trigger: dict | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Keep a table of the latest counts per window and type.

    The query runs in update mode, so a window is emitted whenever it changes;
    the upsert replaces its row. Window dates partition the table and each batch
    rewrites only the dates it touches, which hold minute-level aggregates.
    `state_partitions` is the number of state stores of a new checkpoint; it is
    fixed from then on. The session's shuffle partitions are the default.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns(
            {
                "window_date": F.col("window_start").cast("date"),
                "recorded_at": F.current_timestamp(),
            }
        )
        # The upsert reads the batch several times; the stateful plan runs once.
        rows = rows.persist()
        try:
            if not rows.isEmpty():
                upsert_table(rows, target, keys, partition_cols)
        finally:
            rows.unpersist()

    with _shuffle_partitions(stream.sparkSession, state_partitions):
        return start_batches(stream, write, "update", checkpoint, trigger)


@contextmanager
def _shuffle_partitions(spark: SparkSession, number: int | None) -> Iterator[None]:
    """A query keeps the setting that holds while it starts."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if number is not None:
        spark.conf.set(key, str(number))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_stream_jdbc(
    stream: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append every changed window to a JDBC table, as an operational feed.

    A batch that is repeated after a failure appends its rows again, under the same batch_id.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id)).persist()
        try:
            if not rows.isEmpty():
                jdbc_append(rows, url, table, properties)
        finally:
            rows.unpersist()

    return start_batches(stream, write, "update", checkpoint, trigger)


def write_stream_split(
    raw: DataFrame,
    valid_path: str,
    dlq_path: str,
    checkpoint: str,
    allowed: tuple[str, ...],
    trigger: dict | None = None,
) -> StreamingQuery:
    """Send messages that pass the classifier to one table and the others to the dead letters.

    A batch is classified once. Its output goes to a partition of its own, named by the
    stream's id and the batch, so a repeated batch overwrites what it wrote before, and a
    stream with another checkpoint overwrites nothing.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"stream={stream_id(batch.sparkSession, checkpoint)}/batch_id={batch_id}"
        messages = batch.withColumn("value", F.col("value").cast("string"))
        classified = classify_messages(
            messages,
            allowed=allowed,
            as_of=F.col("timestamp"),
            aliases=STREAM_ALIASES,
        ).persist()
        try:
            _write_batch(
                classified.filter("reason IS NULL").drop("reason", "value").withColumnRenamed(
                    "fixed_value", "value"
                ),
                valid_path,
                place,
            )
            _write_batch(
                classified.filter("reason IS NOT NULL").drop("fixed_value", "event_type"),
                dlq_path,
                place,
            )
        finally:
            classified.unpersist()

    return start_batches(raw, write, "append", checkpoint, trigger)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of a checkpoint's stream, which is there from before the first batch."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata")
    return text.select(F.get_json_object("value", "$.id")).first()[0]


def _write_batch(rows: DataFrame, path: str, place: str) -> None:
    rows.hint("rebalance").write.mode("overwrite").parquet(f"{path.rstrip('/')}/{place}")


def start_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    mode: str,
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    """Run `write` on every micro-batch."""
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start()
    )
