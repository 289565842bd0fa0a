"""Long-running stream jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.messages import VALID_EVENT_TYPES
from tidemark.plans.lake import Lake
from tidemark.sources.messages import read_event_stream
from tidemark.streaming.feed import Feed, write_stream_feed
from tidemark.streaming.health import ProgressLog
from tidemark.streaming.late import write_stream_counts
from tidemark.streaming.metrics import decode_events, first_copies, minute_counts
from tidemark.streaming.sinks import write_stream_split, write_stream_upsert


def live_metrics(
    spark: SparkSession,
    lake: Lake,
    source: str,
    trigger: dict | None = None,
    state_partitions: int | None = None,
    drop_copies: bool = False,
    **opts,
) -> StreamingQuery:
    """Minute counts of the event stream, kept in the live metrics table.

    With `drop_copies`, events that repeat user, type and second count once. That is decided
    for the life of the checkpoint, as it is part of the stream's state.
    """
    events = decode_events(read_event_stream(spark, source, **opts))
    counts = minute_counts(first_copies(events), watermark=None) if drop_copies else minute_counts(events)
    return write_stream_upsert(
        counts,
        lake.table("live_event_metrics"),
        lake.checkpoint("live_metrics"),
        trigger=trigger,
        state_partitions=state_partitions,
    )


def live_counts(
    spark: SparkSession, lake: Lake, source: str, trigger: dict | None = None, **opts
) -> StreamingQuery:
    """Minute counts of the event stream, and the events that came too late for theirs."""
    return write_stream_counts(
        decode_events(read_event_stream(spark, source, **opts)),
        lake.table("live_event_totals"),
        lake.table("late_events"),
        lake.table("live_event_marks"),
        lake.checkpoint("live_counts"),
        trigger=trigger,
    )


def live_feed(
    spark: SparkSession, lake: Lake, source: str, feed: Feed, trigger: dict | None = None, **opts
) -> StreamingQuery:
    """Minute counts of the event stream, appended to a relational table, each batch once."""
    counts = minute_counts(decode_events(read_event_stream(spark, source, **opts)))
    return write_stream_feed(counts, feed, lake.checkpoint("live_feed"), trigger)


def log_progress(spark: SparkSession, lake: Lake) -> ProgressLog:
    """Keep the progress of this session's streams from now on."""
    listener = ProgressLog(spark, lake.log("stream_progress"))
    spark.streams.addListener(listener)
    return listener


def split_messages(
    spark: SparkSession,
    lake: Lake,
    source: str,
    allowed: tuple[str, ...] = VALID_EVENT_TYPES,
    trigger: dict | None = None,
    **opts,
) -> StreamingQuery:
    """Route raw messages to the valid or the dead-letter table."""
    raw = read_event_stream(spark, source, **opts)
    return write_stream_split(
        raw,
        lake.table("valid_messages"),
        lake.table("dead_letters"),
        lake.checkpoint("split_messages"),
        allowed,
        trigger,
    )
