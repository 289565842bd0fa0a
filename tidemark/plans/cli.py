"""Command line of the batch and stream jobs.

    spark-submit run_job.py product-metrics --lake hdfs:///lake \
        --start 2024-01-01T00:00 --end 2024-01-01T01:00
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from tidemark.functions.intervals import moment
from tidemark.plans import batch, checks, incremental, reporting, stream, upkeep
from tidemark.plans.lake import Lake
from tidemark.session import build_session
from tidemark.sources.files import read_manifest
from tidemark.sources.jdbc import read_events_jdbc
from tidemark.sources.splits import SplitColumn, read_split_jdbc
from tidemark.streaming.feed import Feed


def _extract(spark, lake, a):
    iv = (a.start, a.end)
    if a.url and a.by_rows:
        column = SplitColumn("created_at", is_time=True)
        low, high = (column.number(moment(m)) for m in iv)
        properties = {"driver": a.driver} if a.driver else {}
        source = read_split_jdbc(
            spark, a.url, a.table, column, low, high, a.partitions, spread="id", properties=properties
        )
    elif a.url:
        source = read_events_jdbc(spark, a.url, a.table, iv, num_partitions=a.partitions)
    else:
        source = spark.read.parquet(a.path)
    incremental.extract_noted(source, lake, iv)


def _stream_options(a) -> dict:
    if a.source == "kafka":
        return {"servers": a.servers, "topic": a.topic}
    return {"path": a.path, "schema": "value STRING, timestamp TIMESTAMP"}


def _feed(spark, lake, a):
    properties = {"driver": a.driver} if a.driver else {}
    columns = ("window_start", "window_end", "event_type", "event_count", "batch_id")
    feed = Feed(a.url, a.table, columns, properties)
    stream.live_feed(spark, lake, a.source, feed, **_stream_options(a)).awaitTermination()


def _replay(spark, lake, a):
    source = {"servers": a.servers, "topic": a.topic} if a.source == "kafka" else {"path": a.path}
    sink = {"servers": a.servers, "topic": a.target} if a.source == "kafka" else {"path": a.target}
    checks.replay_dead_letters(
        spark, lake, a.as_of, a.source, a.source, source, sink, a.max_messages
    )


# Job name -> (required options, function).
JOBS: dict[str, tuple[tuple[str, ...], Callable]] = {
    "extract": (("start", "end"), _extract),
    "product-metrics": (
        ("start", "end"),
        lambda s, lake, a: batch.product_metrics(s, lake, (a.start, a.end)),
    ),
    "tenant-metrics": (
        ("manifest", "as_of"),
        lambda s, lake, a: batch.tenant_metrics(s, lake, read_manifest(s, a.manifest), a.as_of),
    ),
    "promote": (("start", "end"), lambda s, lake, a: batch.promote(s, lake, (a.start, a.end))),
    "backfill": (("as_of",), lambda s, lake, a: batch.backfill_products(s, lake, a.as_of)),
    "adaptive": (
        ("start", "end"),
        lambda s, lake, a: batch.adaptive_run(s, lake, (a.start, a.end)),
    ),
    "batch-tenant": (
        ("start", "end"),
        lambda s, lake, a: batch.batch_tenant(s, lake, (a.start, a.end)),
    ),
    "null-gate": (("start", "end"), lambda s, lake, a: checks.null_gate(s, lake, (a.start, a.end))),
    "duplicates": (
        ("start", "end"),
        lambda s, lake, a: checks.duplicate_check(s, lake, (a.start, a.end)),
    ),
    "distribution": (("as_of",), lambda s, lake, a: checks.distribution_check(s, lake, a.as_of)),
    "schema": ((), lambda s, lake, a: checks.schema_check(s, lake)),
    "row-count": (
        ("start", "end"),
        lambda s, lake, a: checks.row_count_check(s, lake, (a.start, a.end)),
    ),
    "errors": (("start", "end"), lambda s, lake, a: checks.error_check(s, lake, (a.start, a.end))),
    "freshness": (("as_of",), lambda s, lake, a: checks.freshness_check(s, lake, a.as_of)),
    "freshness-report": ((), lambda s, lake, a: checks.freshness_report(s, lake)),
    "recent-failures": (("as_of",), lambda s, lake, a: checks.latest_failures(s, lake, a.as_of)),
    "uptime": (
        ("start", "end"),
        lambda s, lake, a: checks.uptime_report(s, lake, (a.start, a.end)),
    ),
    "payload-keys": (
        ("start", "end", "keys"),
        lambda s, lake, a: checks.payload_check(
            s, lake, (a.start, a.end), tuple(a.keys.split(","))
        ),
    ),
    "payload-paths": (
        ("start", "end", "paths"),
        lambda s, lake, a: checks.payload_path_check(
            s, lake, (a.start, a.end), dict(p.split("=", 1) for p in a.paths.split(";"))
        ),
    ),
    "stream-state": (("as_of",), lambda s, lake, a: checks.stream_state_check(s, lake, a.as_of)),
    "stream-health": (("as_of",), lambda s, lake, a: checks.stream_check(s, lake, a.as_of)),
    "failures": (("as_of",), lambda s, lake, a: checks.failure_report(s, lake, a.as_of)),
    "consumer-lag": (("as_of",), lambda s, lake, a: checks.lag_check(s, lake, a.as_of)),
    "cluster-health": (
        ("start", "end"),
        lambda s, lake, a: checks.cluster_check(s, lake, (a.start, a.end)),
    ),
    "replay-dead-letters": (("as_of", "target"), _replay),
    "daily-summary": (
        ("start", "end"),
        lambda s, lake, a: reporting.daily_summary(s, lake, (a.start, a.end)),
    ),
    "hourly-rollup": (
        ("start", "end"),
        lambda s, lake, a: reporting.hourly_rollup(s, lake, (a.start, a.end)),
    ),
    "rollup-changed": ((), lambda s, lake, a: incremental.rollup_changed_hours(s, lake)),
    "user-bitmaps": (
        ("start", "end"),
        lambda s, lake, a: reporting.user_bitmaps(s, lake, (a.start, a.end)),
    ),
    "weekly-cohorts-from-days": (
        ("as_of",),
        lambda s, lake, a: reporting.weekly_cohorts_from_days(s, lake, a.as_of),
    ),
    "weekly-cohorts": (("as_of",), lambda s, lake, a: reporting.weekly_cohorts(s, lake, a.as_of)),
    "monthly-kpis": (("as_of",), lambda s, lake, a: reporting.monthly_kpis(s, lake, a.as_of).show()),
    "cross-tenant": (
        ("manifest", "as_of"),
        lambda s, lake, a: reporting.cross_tenant(s, lake, read_manifest(s, a.manifest), a.as_of),
    ),
    "clean-landing": (
        ("as_of",),
        lambda s, lake, a: upkeep.clean_landing(s, lake, a.as_of, dry_run=not a.apply),
    ),
    "purge-metrics": (("as_of",), lambda s, lake, a: upkeep.purge_metrics(s, lake, a.as_of).show()),
    "archive-users": (("as_of",), lambda s, lake, a: upkeep.archive_users(s, lake, a.as_of)),
    "compact": (("dates",), lambda s, lake, a: upkeep.compact_bronze(s, lake, a.dates.split(","))),
    "cluster-events": (
        ("start", "end", "files"),
        lambda s, lake, a: upkeep.cluster_events(s, lake, (a.start, a.end), a.files),
    ),
    "live-feed": (("url",), _feed),
    "live-metrics": (
        (),
        lambda s, lake, a: stream.log_progress(s, lake) and stream.live_metrics(
            s, lake, a.source, state_partitions=a.state_partitions,
            drop_copies=a.drop_copies, **_stream_options(a),
        ).awaitTermination(),
    ),
    "live-counts": (
        (),
        lambda s, lake, a: stream.live_counts(
            s, lake, a.source, **_stream_options(a)
        ).awaitTermination(),
    ),
    "split-messages": (
        (),
        lambda s, lake, a: stream.split_messages(
            s, lake, a.source, **_stream_options(a)
        ).awaitTermination(),
    ),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="run_job")
    p.add_argument("job", choices=sorted(JOBS))
    p.add_argument("--lake", required=True)
    for name in ("start", "end", "as-of", "manifest", "dates", "url", "path", "servers", "topic",
                 "keys", "paths", "driver"):
        p.add_argument(f"--{name}")
    p.add_argument("--table", default="raw_events")
    p.add_argument("--partitions", type=int, default=32)
    p.add_argument("--files", type=int)
    p.add_argument("--by-rows", action="store_true", help="split a database read by counted rows")
    p.add_argument("--source", default="kafka")
    p.add_argument("--target")
    p.add_argument("--max-messages", type=int)
    p.add_argument("--state-partitions", type=int)
    p.add_argument("--drop-copies", action="store_true", help="count repeated events once")
    p.add_argument("--apply", action="store_true", help="delete instead of reporting")
    return p


def main(argv: list[str] | None = None) -> None:
    cli = parser()
    args = cli.parse_args(argv)
    required, run = JOBS[args.job]
    missing = [name for name in required if getattr(args, name) is None]
    if missing:
        cli.error(f"{args.job} needs " + ", ".join("--" + m.replace("_", "-") for m in missing))
    spark = build_session(f"tidemark-{args.job}")
    run(spark, Lake(args.lake), args)
