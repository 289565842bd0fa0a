"""Jobs on a small lake, run twice, and the shape of query plans."""

from __future__ import annotations

import json
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.layout import HOURLY
from tidemark.operators import clustering
from tidemark.plans import batch, checks, cli, reporting, stream, upkeep
from tidemark.plans.lake import Lake
from tidemark.session import scratch_dir
from tidemark.sinks import storage, tables
from tidemark.streaming import health
from workload.queries import QUERIES

T0 = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def lake(spark):
    """A lake with eight days of landed events: 24 per day, one per hour, and a NULL user."""
    place = Lake(scratch_dir(spark, "lake"))
    rows = []
    for i in range(24 * 8):
        kind = ("purchase", "view", "refund")[i % 3]
        user = None if i == 5 else f"u{i % 4}"
        payload = json.dumps({"product_id": i % 5, "amount": i})
        rows.append((i, user, kind, payload, T0 + timedelta(hours=i, minutes=5)))
    rows.append((1000, "u1", "view", "{}", T0 + timedelta(hours=1, minutes=5)))
    rows.append((2000, "u1", "view", "{}", T0 + timedelta(days=8)))  # outside the interval
    source = spark.createDataFrame(rows, schemas.LANDING_RAW)
    for _ in range(2):
        batch.extract(source, place, ("2024-01-01", "2024-01-09"))
    users = [(f"u{i}", "", T0 - timedelta(days=300), None) for i in range(6)]
    tables.replace_table(spark.createDataFrame(users, schemas.USERS), place.table("users"))
    return place


def twice(job, *args, **kwargs):
    job(*args, **kwargs)
    return job(*args, **kwargs)


def test_landing_is_idempotent(spark, lake):
    assert lake.events(spark).count() == 193
    assert lake.events(spark).filter("product_id IS NOT NULL").count() == 192


def test_partial_partitions_are_refused(spark, lake):
    source = spark.createDataFrame([], schemas.LANDING_RAW)
    with pytest.raises(ValueError):
        batch.extract(source, lake, ("2024-01-01", "2024-01-01T00:30"))
    with pytest.raises(ValueError):
        batch.promote(spark, lake, ("2024-01-01", "2024-01-01T01:00"))
    with pytest.raises(ValueError):
        reporting.daily_summary(spark, lake, ("2024-01-01T05:00", "2024-01-02"))
    assert lake.events(spark).count() == 193


def test_product_metrics_keep_every_window(spark, lake):
    for start, end in (("2024-01-01", "2024-01-02"), ("2024-01-02", "2024-01-03")):
        twice(batch.product_metrics, spark, lake, (start, end))
    gold = spark.read.parquet(lake.gold(batch.PRODUCT_GOLD))
    assert {r.window_start for r in gold.collect()} == {T0, T0 + timedelta(days=1)}
    assert gold.agg(F.sum("total_conversions")).first()[0] == 16
    twice(batch.batch_tenant, spark, lake, ("2024-01-01", "2024-01-02"))
    joined = spark.read.parquet(lake.gold("batch_tenant_comparison"))
    assert joined.agg(F.sum("batch_conversions")).first()[0] == 8


def test_tenants(spark, lake):
    events = lake.events(spark).withColumn(
        "tenant", F.when(F.col("id") % 2 == 0, "even").otherwise("odd")
    )
    HOURLY.assign(events, "created_at").write.partitionBy("tenant", *HOURLY.columns).parquet(
        lake.tenant_landing
    )
    manifest = spark.createDataFrame(
        [("odd", 1, 0), ("even", 30, 1), ("none", 5, 2)],
        "client_id STRING, retention_days INT, position INT",
    )
    twice(batch.tenant_metrics, spark, lake, manifest, "2024-01-09")
    gold = spark.read.parquet(lake.gold(batch.TENANT_TABLE))
    sums = gold.groupBy("tenant_id").agg(F.sum("total_conversions").alias("n"))
    totals = {r.tenant_id: r.n for r in sums.collect()}
    assert totals == {"even": 32, "odd": 4}
    twice(reporting.cross_tenant, spark, lake, manifest, "2024-01-08")
    report = spark.read.parquet(lake.gold("cross_tenant_comparison")).collect()
    assert [(r.report_week, r.top_tenant) for r in report] == [(date(2024, 1, 8), "even")]
    assert len(json.loads(report[0].details)["tenants"]) == 3


def test_backfill_fills_only_gaps(spark, lake):
    batch.backfill_products(spark, lake, "2024-01-09")
    path = lake.gold("daily_" + batch.PRODUCT_GOLD)
    full = spark.read.parquet(path)
    assert full.select("dt").distinct().count() == 7
    kept = storage.children(spark, f"{path}/dt=2024-01-03")
    storage.delete(spark, f"{path}/dt=2024-01-05")
    twice(batch.backfill_products, spark, lake, "2024-01-09")
    assert spark.read.parquet(path).agg(F.sum("total_conversions")).first()[0] == 56
    assert storage.children(spark, f"{path}/dt=2024-01-03") == kept


def test_bronze_and_compaction(spark, lake):
    twice(batch.promote, spark, lake, ("2024-01-01", "2024-01-09"))
    bronze = spark.read.parquet(lake.bronze)
    assert bronze.count() == 191  # without the NULL user and the copy
    twice(upkeep.compact_bronze, spark, lake, ["2024-01-01", "2024-01-02"])
    manifest = spark.read.parquet(lake.log("compaction_manifest"))
    assert {(str(r.compaction_date), r.status) for r in manifest.collect()} == {
        ("2024-01-01", "complete"),
        ("2024-01-02", "complete"),
    }
    assert spark.read.parquet(lake.gold("compacted")).count() == 47


def test_adaptive_run_logs_every_interval(spark, lake):
    for hour in range(4):
        start = T0 + timedelta(days=3, hours=hour)
        twice(batch.adaptive_run, spark, lake, (start, start + timedelta(hours=1)))
    log = spark.read.parquet(lake.table("pipeline_run_log")).orderBy("interval_start").collect()
    assert [r.mode for r in log] == ["incremental", "incremental", "incremental", "full"]
    assert [r.row_count for r in log] == [1, 1, 1, 1]


def test_quality_jobs(spark, lake):
    day = ("2024-01-01", "2024-01-02")
    twice(checks.null_gate, spark, lake, day)
    assert [r.event_id for r in spark.read.parquet(lake.log("dq_quarantine")).collect()] == [5]
    twice(checks.duplicate_check, spark, lake, day)
    assert [r.event_id for r in spark.read.parquet(lake.log("dq_duplicate_audit")).collect()] == [
        1000
    ]
    twice(checks.row_count_check, spark, lake, day)
    sla = spark.read.parquet(lake.log("batch_sla_log"))
    assert (sla.count(), sla.filter("sla_passed").count()) == (24, 0)
    twice(checks.distribution_check, spark, lake, "2024-01-09")
    audit = spark.read.parquet(lake.log("dq_distribution_audit")).collect()
    assert [str(r.report_date) for r in audit] == ["2024-01-08"]
    checks.schema_check(spark, lake)
    drift = spark.read.parquet(lake.log("dq_schema_drift_log")).first()
    assert not drift.drift_detected and drift.extra_cols == []


def test_monitoring_jobs(spark, lake):
    checks.freshness_check(spark, lake, "2024-01-09T00:00:00")
    row = spark.read.parquet(lake.log("sla_measurement_log")).first()
    assert row.source_lag_seconds == 55 * 60
    for job in (checks.stream_check, checks.failure_report, checks.lag_check):
        job(spark, lake, "2024-01-09")
    twice(checks.error_check, spark, lake, ("2024-01-01", "2024-01-02"))
    readings = spark.createDataFrame([("spark", T0, True, 0)], schemas.HEALTH_READINGS)
    tables.replace_table(readings, lake.table("health_readings"))
    checks.cluster_check(spark, lake, ("2024-01-01", "2024-01-02"))
    health = spark.read.parquet(lake.log("cluster_health_log"))
    assert [r.status for r in health.collect()] == ["degraded"]


def test_reports_of_measurements(spark, lake):
    for hour in ("00", "12"):
        checks.freshness_check(spark, lake, f"2024-01-09T{hour}:00:00")
    checks.freshness_report(spark, lake)
    assert spark.read.parquet(lake.gold("freshness_compliance")).first().measurements >= 2
    readings = [("spark", T0, True, 3), ("spark", T0 + timedelta(hours=1), False, 3)]
    tables.replace_table(
        spark.createDataFrame(readings, schemas.HEALTH_READINGS), lake.table("health_readings")
    )
    checks.uptime_report(spark, lake, ("2024-01-01", "2024-01-02"))
    assert spark.read.parquet(lake.gold("component_uptime")).count() == 1
    checks.payload_check(spark, lake, ("2024-01-01", "2024-01-02"), ("product_id", "absent"))
    keys = spark.read.parquet(lake.log("dq_payload_key_log"))
    assert "absent" in keys.drop("checked_at").toPandas().to_string()
    checks.latest_failures(spark, lake, "2024-01-09")


def test_report_jobs(spark, lake):
    twice(reporting.daily_summary, spark, lake, ("2024-01-01", "2024-01-03"))
    daily = spark.read.parquet(lake.gold("daily_event_summary"))
    assert daily.agg(F.sum("event_count")).first()[0] == 49
    twice(reporting.weekly_cohorts, spark, lake, "2024-01-08")
    weekly = spark.read.parquet(lake.gold("weekly_cohort_metrics")).collect()
    assert [(r.event_count, r.unique_users) for r in weekly] == [(168, 4)]
    csv = spark.read.option("header", True).csv(lake.gold("reports/weekly_cohorts_2024-01-08"))
    assert csv.count() == 1
    kpis = twice(reporting.monthly_kpis, spark, lake, "2024-02-01").collect()
    assert [(r.report_month, r.total_purchases) for r in kpis] == [("2024-01", 64)]
    reporting.monthly_kpis(spark, lake, "2024-03-01")
    stored = spark.read.parquet(lake.gold("monthly_kpi_report")).collect()
    assert [r.report_month for r in stored] == ["2024-01"]


def test_stream_rollup_and_purge(spark, lake):
    source = scratch_dir(spark, "messages")
    rows = [
        (json.dumps({"userId": "u", "eventType": "view"}), T0 + timedelta(hours=12 * i))
        for i in range(6)
    ]
    spark.createDataFrame(rows, "value STRING, timestamp TIMESTAMP").write.parquet(source)
    options = {"path": source, "schema": "value STRING, timestamp TIMESTAMP"}
    for _ in range(2):
        stream.live_metrics(
            spark, lake, "parquet", {"availableNow": True}, **options
        ).awaitTermination()
        stream.split_messages(
            spark, lake, "parquet", ("view",), {"availableNow": True}, **options
        ).awaitTermination()
    assert spark.read.parquet(lake.table("valid_messages")).count() == 6
    twice(reporting.hourly_rollup, spark, lake, ("2024-01-01", "2024-01-05"))
    assert spark.read.parquet(lake.gold("hourly_metrics_rollup")).count() == 6
    # Give the windows distinct ages: one date expires whole, one in part.
    path = lake.table("live_event_metrics")
    aged = spark.read.parquet(path).withColumn("recorded_at", F.col("window_end"))
    tables.replace_partitions(aged, path, ("window_date",))
    cutoff = T0 + timedelta(days=1, hours=6)
    stats = upkeep.purge_metrics(spark, lake, cutoff + timedelta(days=90)).first()
    assert tuple(stats) == (6, 3, 3)
    left = spark.read.parquet(path)
    assert left.count() == 3 and left.agg(F.min("window_start")).first()[0] > cutoff
    assert not storage.exists(spark, f"{path}/window_date=2024-01-01")


def test_dead_letter_replay(spark, lake):
    source, target = scratch_dir(spark, "dlq"), scratch_dir(spark, "main")
    rows = [(0, i, json.dumps({"user_id": "u", "event_type": k})) for i, k in enumerate(["view", "bad"])]
    spark.createDataFrame(rows, schemas.DLQ_MESSAGES).write.json(source)
    twice(
        checks.replay_dead_letters,
        spark, lake, "2024-01-31", "json", "text", {"path": source}, {"path": target},
    )
    assert spark.read.text(target).count() == 1
    log = spark.read.parquet(lake.log("dlq_unrecoverable_log")).collect()
    assert [(r.kafka_offset, r.reason) for r in log] == [(1, "invalid_event_type: bad")]


def test_archive_then_soft_delete(spark, lake):
    twice(upkeep.archive_users, spark, lake, "2024-01-20")
    archived = spark.read.parquet(lake.gold("archived_users"))
    assert sorted(r.user_id for r in archived.collect()) == ["u4", "u5"]
    users = spark.read.parquet(lake.table("users"))
    assert sorted(r.user_id for r in users.filter("deleted_at IS NOT NULL").collect()) == ["u4", "u5"]
    upkeep.archive_users(spark, lake, "2024-02-20")
    assert spark.read.parquet(lake.gold("archived_users")).count() == 2


def test_archive_with_a_limit_loses_nobody(spark, lake):
    twice(upkeep.archive_users, spark, lake, "2024-01-20", limit=1)
    archived = spark.read.parquet(lake.gold("archived_users")).collect()
    users = spark.read.parquet(lake.table("users")).filter("deleted_at IS NOT NULL").collect()
    assert sorted(r.user_id for r in archived) == sorted(r.user_id for r in users) == ["u4", "u5"]


def test_a_day_without_purchases_is_backfilled_once(spark, lake):
    for _ in range(2):
        batch.backfill_products(spark, lake, "2024-01-30")
        days = spark.read.parquet(lake.log("empty_days"))
        assert days.filter("dt >= '2024-01-23'").count() == 7
    none = spark.createDataFrame([], "client_id STRING, target_table STRING, retention_days INT, position INT")
    batch.tenant_metrics(spark, lake, none, "2024-01-30")


def test_landing_cleanup_reports_first(spark, lake):
    before = lake.events(spark).count()
    plan = upkeep.clean_landing(spark, lake, "2100-01-01")
    assert plan.first().expired and lake.events(spark).count() == before


def test_payload_paths_are_logged_as_a_job(spark, lake):
    cli.main(
        ["payload-paths", "--lake", lake.root, "--start", "2024-01-01", "--end", "2024-01-02",
         "--paths", "$.product_id=BIGINT;$.amount=STRING"]
    )
    log = spark.read.parquet(lake.log("dq_payload_path_log"))
    found = {(r.path, r.actual_type, r.status): r["rows"] for r in log.collect()}
    # One event of the day has an empty payload.
    assert found == {
        ("$.product_id", None, "missing"): 1,
        ("$.amount", "BIGINT", "type_mismatch"): 24,
        ("$.amount", None, "missing"): 1,
    }


def test_clustered_events_as_a_job(spark, lake):
    iv = ("2024-01-01", "2024-01-09")
    cli.main(
        ["cluster-events", "--lake", lake.root, "--start", iv[0], "--end", iv[1], "--files", "8"]
    )
    path = lake.gold("events_by_user")
    found = clustering.read_users(spark, path, schemas.EVENTS, ("2024-01-03", "2024-01-05"), ["u2"])
    want = lake.events(spark, ("2024-01-03", "2024-01-05")).filter("user_id = 'u2'")
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in want.collect()) != []


def test_state_of_the_live_stream_is_logged(spark, lake):
    source = scratch_dir(spark, "live")
    rows = [('{"eventType": "view"}', T0 + timedelta(minutes=m)) for m in (0, 1, 1, 9)]
    schema = "value STRING, timestamp TIMESTAMP"
    spark.createDataFrame(rows, schema).write.parquet(source)
    listener = stream.log_progress(spark, lake)
    try:
        stream.live_metrics(
            spark, lake, "parquet", trigger={"availableNow": True}, state_partitions=2, path=source, schema=schema
        ).awaitTermination()
        for _ in range(100):
            if not health.read_progress(spark, lake.log("stream_progress")).filter("watermark > '2000-01-01'").isEmpty():
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    checks.stream_state_check(spark, lake, "2024-01-01T01:00")
    row = spark.read.parquet(lake.log("stream_state_log")).first()
    assert (row.state_rows, row.open_events, row.oldest_age_s) == (1, 1, 51 * 60)
    assert (row.watermark_delay_s, row.rows_dropped_late) == (53 * 60, 0)


def test_live_counts_keep_late_events(spark, lake):
    source = scratch_dir(spark, "counts")
    schema = "value STRING, timestamp TIMESTAMP"
    for minutes in ((0, 9), (0, 10)):
        rows = [('{"eventType": "view"}', T0 + timedelta(minutes=m)) for m in minutes]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        stream.live_counts(
            spark, lake, "parquet", trigger={"availableNow": True}, path=source, schema=schema
        ).awaitTermination()
    totals = spark.read.parquet(lake.table("live_event_totals"))
    assert sorted(r.window_start.minute for r in totals.collect()) == [0, 9, 10]
    late = spark.read.parquet(lake.table("late_events")).collect()
    assert [(r.kafka_ts, r.watermark) for r in late] == [(T0, T0 + timedelta(minutes=7))]


def test_command_line(spark, lake, capsys):
    cli.main(
        ["row-count", "--lake", lake.root, "--start", "2024-01-02", "--end", "2024-01-02T02:00"]
    )
    log = spark.read.parquet(lake.log("batch_sla_log"))
    assert log.filter("window_start >= '2024-01-02'").count() == 2
    with pytest.raises(SystemExit):
        cli.main(["row-count", "--lake", lake.root])
    assert "--start" in capsys.readouterr().err


# -- plan shapes --------------------------------------------------------------


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


SINKS = {
    "archived_users", "upsert_result", "insert_if_absent_result", "landing_roundtrip",
    "interval_reload_result", "compaction_result", "compaction_manifest", "bronze_promoted",
    "csv_export", "file_retention_plan", "stream_minute_counts", "stream_valid_dlq_split",
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SINKS))
def test_plans_stay_in_the_jvm_without_products(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for forbidden in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert forbidden not in plan


def test_scans_are_pruned_and_filtered(spark, sf_dir):
    length = "spark.sql.maxMetadataStringLength"
    spark.conf.set(length, "1000")
    try:
        plan = plan_of(QUERIES["product_conversions"](spark, sf_dir))
    finally:
        spark.conf.unset(length)
    pushed = plan[plan.index("PushedFilters: [") :].split("]")[0]
    for condition in ("EqualTo(event_type,purchase)", "GreaterThanOrEqual(ts,", "LessThan(ts,"):
        assert condition in pushed
    assert "ReadSchema: struct<ts:timestamp,event_type:string,props:string>" in plan


def test_landing_aggregation_never_reads_the_payload(spark, lake):
    from tidemark.operators.reports import product_conversions

    iv = ("2024-01-01", "2024-01-02")
    plan = plan_of(product_conversions(lake.events(spark, iv), iv))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<event_type:string,product_id:int,created_at:timestamp>" in plan


def test_single_rank_is_limited_before_the_shuffle(spark, sf_dir):
    for name in ("deduplicated_events", "adaptive_mode"):
        plan = plan_of(QUERIES[name](spark, sf_dir))
        below = plan[plan.index("Exchange hashpartitioning") :]
        assert "WindowGroupLimit" in below and "Partial" in below


def test_events_are_read_once(spark, sf_dir):
    for name in ("distribution_drift", "row_count_sla", "daily_event_summary"):
        assert plan_of(QUERIES[name](spark, sf_dir)).count("FileScan parquet") == 1


def test_payload_totals_reuse_the_shuffle(spark, sf_dir):
    df = QUERIES["payload_key_drift"](spark, sf_dir)
    df.collect()
    final = plan_of(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 1
