"""What a stream says about itself: its progress and its state.

A listener keeps the progress of every batch as one small file, named by stream and batch, so a
repeated batch replaces its own. The state of a checkpoint is read with Spark's state readers:
how many rows it holds, which windows, and in how many stores.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.functions.intervals import Moment, ts
from tidemark.schemas import STREAM_PROGRESS
from tidemark.sinks import storage


def progress_row(progress: dict) -> dict:
    """The facts of one batch from its progress."""
    states = progress.get("stateOperators") or []
    return {
        "query_id": progress["id"],
        "run_id": progress["runId"],
        "batch_id": progress["batchId"],
        "triggered_at": progress["timestamp"],
        "input_rows": progress.get("numInputRows", 0),
        "watermark": (progress.get("eventTime") or {}).get("watermark"),
        "state_rows": sum(s["numRowsTotal"] for s in states),
        "rows_dropped_late": sum(s.get("numRowsDroppedByWatermark", 0) for s in states),
        "duration_ms": (progress.get("durationMs") or {}).get("triggerExecution", 0),
    }


class ProgressLog(StreamingQueryListener):
    """Writes the progress of a session's streams below a path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self._path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        row = progress_row(json.loads(event.progress.json))
        name = f"{self._path}/{row['query_id']}-{row['batch_id']:012d}.json"
        storage.write_text(self._spark, name, json.dumps(row))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per stream and batch; none if no stream has run."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], STREAM_PROGRESS)
    return spark.read.schema(STREAM_PROGRESS).json(path)


def latest_progress(progress: DataFrame, as_of: Moment) -> DataFrame:
    """The last batch of each stream with how long ago it began and how late its watermark is."""
    newest = progress.groupBy("query_id").agg(
        F.max_by(F.struct(*progress.columns), "batch_id").alias("p"),
        F.sum("input_rows").alias("total_input_rows"),
        F.sum("rows_dropped_late").alias("total_dropped_late"),
    )
    seconds = lambda c: F.unix_seconds(ts(as_of)) - F.unix_seconds(c)
    return newest.select(
        "query_id",
        F.col("p.batch_id").alias("batch_id"),
        F.col("p.state_rows").alias("state_rows"),
        F.col("p.watermark").alias("watermark"),
        seconds("p.triggered_at").alias("seconds_since_batch"),
        seconds("p.watermark").alias("watermark_delay_s"),
        "total_input_rows",
        "total_dropped_late",
    )


def window_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(window_start, window_end, event_type, event_count) that the state of the counts holds."""
    state = spark.read.format("statestore").load(checkpoint)
    key = F.col("key")
    return state.select(
        key.getField(state.schema["key"].dataType.names[0])["start"].alias("window_start"),
        key.getField(state.schema["key"].dataType.names[0])["end"].alias("window_end"),
        key["event_type"].alias("event_type"),
        F.col("value")["count"].alias("event_count"),
    )


def state_stores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator, stores, first_batch, last_batch) of the stateful operators of a checkpoint."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.groupBy(F.col("operatorName").alias("operator")).agg(
        F.max("numPartitions").alias("stores"),
        F.min("minBatchId").alias("first_batch"),
        F.max("maxBatchId").alias("last_batch"),
    )


def state_health(state: DataFrame, as_of: Moment) -> DataFrame:
    """One row: open windows and the events counted in them, and the age of the oldest.

    An oldest window that stays while time goes on is one that nothing closes: a stuck source
    or a watermark that does not move. Empty state gives zeros and no age.
    """
    return state.agg(
        F.count(F.lit(1)).alias("state_rows"),
        F.coalesce(F.sum("event_count"), F.lit(0)).alias("open_events"),
        F.min("window_start").alias("oldest_window"),
        F.max("window_start").alias("newest_window"),
    ).withColumn("oldest_age_s", F.unix_seconds(ts(as_of)) - F.unix_seconds("oldest_window"))
