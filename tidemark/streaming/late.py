"""Window counts that keep the rows behind the watermark.

Spark's windowed aggregation drops a row whose window the watermark has closed, and only counts
how many it dropped. Here each micro-batch of events is divided by the watermark instead: rows
of open windows are added to the table of counts, the others go to a table of late rows with
the watermark they missed. Both together hold every row once.

The watermark is the one Spark would use: the greatest event time of the batches before, less
the delay. It is kept in a table of marks, one row per batch, written last. A batch that is
repeated after a failure finds the same mark of its predecessor, overwrites its late rows, and
adds its counts to what stood there before it, which each count remembers beside the batch that
changed it last. So repeating changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schemas import LATE_MARKS, WINDOW_TOTALS
from tidemark.sinks import storage
from tidemark.sinks.tables import read_or_empty, upsert_table
from tidemark.streaming.metrics import WATERMARK, WINDOW
from tidemark.streaming.sinks import start_batches, stream_id

KEYS = ("window_date", "window_start", "event_type")
#: Marks of so many batches stay, for those that look at them.
MARKS_KEPT = 1000


def place_of(stream: str, batch_id: int) -> str:
    return f"stream={stream}/batch_id={batch_id}"


def with_windows(events: DataFrame, time_col: str, window: str) -> DataFrame:
    """Events with the start and end of their tumbling window."""
    timed = events.withColumn("_window", F.window(time_col, window))
    return timed.withColumns(
        {"window_start": F.col("_window.start"), "window_end": F.col("_window.end")}
    ).drop("_window")


def split_late(rows: DataFrame, watermark: Column | None) -> tuple[DataFrame, DataFrame]:
    """(rows of open windows, rows of windows that end at the watermark or before)."""
    if watermark is None:
        return rows, rows.limit(0).withColumn("watermark", F.lit(None).cast("timestamp"))
    closed = F.col("window_end") <= watermark
    return rows.filter(~closed), rows.filter(closed).withColumn("watermark", watermark)


def add_counts(stored: DataFrame, new: DataFrame, batch: str) -> DataFrame:
    """New totals of the windows in `new` after the batch named `batch`.

    A total that this batch has already changed starts from what it was before.
    """
    before = F.when(F.col("t.last_batch") == batch, F.col("t.count_before")).otherwise(
        F.coalesce("t.event_count", F.lit(0))
    )
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"t.{k}")) for k in KEYS]
    return new.alias("n").join(stored.alias("t"), same, "left").select(
        *(F.col(f"n.{c}") for c in (*KEYS, "window_end")),
        (before + F.col("n.event_count")).alias("event_count"),
        before.alias("count_before"),
        F.lit(batch).alias("last_batch"),
    )


def next_mark(rows: DataFrame, time_col: str, watermark: Column | None, delay: str) -> DataFrame:
    """One row: the watermark for the batch after `rows`. It never goes back."""
    newest = F.max(F.date_trunc("millisecond", time_col))
    after = newest - F.expr(f"INTERVAL '{delay}'")
    return rows.agg((after if watermark is None else F.greatest(after, watermark)).alias("watermark"))


def write_stream_counts(
    events: DataFrame,
    target: str,
    late: str,
    marks: str,
    checkpoint: str,
    time_col: str = "kafka_ts",
    window: str = WINDOW,
    delay: str = WATERMARK,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep a table of counts per window and type, and a table of the rows that came too late.

    `events` has `event_type` and the event time, which is not null; other columns go along
    with late rows. The counts are partitioned by date, and each batch rewrites the dates it
    touches; late rows are partitioned by stream and batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        mark = _mark(spark, marks, stream, batch_id - 1)
        rows = with_windows(batch, time_col, window).persist()
        try:
            timely, behind = split_late(rows, mark)
            here = place_of(stream, batch_id)
            behind.hint("rebalance").write.mode("overwrite").parquet(f"{late.rstrip('/')}/{here}")
            new = timely.groupBy(
                F.col("window_start").cast("date").alias("window_date"),
                "window_start", "window_end", "event_type",
            ).agg(F.count(F.lit(1)).alias("event_count")).persist()
            try:
                # The dates of a batch, which are directories of the table.
                dates = [r.window_date for r in new.select("window_date").distinct().collect()]
                if dates:
                    scope = F.col("window_date").isin(dates)
                    stored = read_or_empty(spark, target, WINDOW_TOTALS).filter(scope)
                    upsert_table(
                        add_counts(stored, new, here), target, KEYS, ("window_date",), scope=scope
                    )
            finally:
                new.unpersist()
            # Written last: a batch is complete when its mark exists.
            after = next_mark(rows, time_col, mark, delay)
            after.write.mode("overwrite").parquet(f"{marks.rstrip('/')}/{here}")
        finally:
            rows.unpersist()
        storage.delete(spark, f"{marks.rstrip('/')}/{place_of(stream, batch_id - MARKS_KEPT)}")

    return start_batches(events, write, "append", checkpoint, trigger)


def _mark(spark: SparkSession, marks: str, stream: str, batch_id: int) -> Column | None:
    """The watermark after a batch; None if there was none."""
    path = f"{marks.rstrip('/')}/{place_of(stream, batch_id)}"
    if batch_id < 0 or not storage.exists(spark, path):
        return None
    value = spark.read.schema(LATE_MARKS).parquet(path).select(F.unix_micros("watermark")).first()[0]
    return None if value is None else F.timestamp_micros(F.lit(value))

