"""Write modes: repeated runs, other partitions, empty inputs."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.layout import DAILY, HOURLY, PLAIN_HOURS
from tidemark.operators import lifecycle
from tidemark.session import scratch_dir
from tidemark.sinks import exports, storage, tables
from tidemark.sources import files, jdbc, landing, messages

T0 = datetime(2024, 1, 1, 10)


def events(spark, ids_and_times):
    rows = [(i, "u", "view", "{}", 1, None, t) for i, t in ids_and_times]
    return spark.createDataFrame(rows, schemas.EVENTS)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.fixture
def path(spark):
    return scratch_dir(spark, "sink")


def test_interval_replacement(spark, path):
    first = events(spark, [(1, T0), (2, T0 + timedelta(hours=1)), (3, T0 + timedelta(hours=2))])
    for _ in range(2):
        tables.replace_interval(first, path, HOURLY)
        assert ids(landing.read_landing(spark, path)) == [1, 2, 3]
    iv = (T0, T0 + timedelta(hours=2))
    tables.replace_interval(events(spark, [(9, T0)]), path, HOURLY, iv)
    assert ids(landing.read_landing(spark, path)) == [3, 9]
    tables.replace_interval(events(spark, []), path, HOURLY, iv)
    assert ids(landing.read_landing(spark, path)) == [3]


def test_landing_scan_prunes_and_filters(spark, path):
    rows = [(h, T0 + timedelta(hours=h, minutes=30)) for h in range(24)]
    tables.replace_interval(events(spark, rows), path, HOURLY)
    iv = (T0 + timedelta(hours=2, minutes=30), T0 + timedelta(hours=5, minutes=30))
    df = landing.read_landing(spark, path, iv=iv)
    assert ids(df) == [2, 3, 4]
    plan = df._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(year" in plan.toString()
    assert "GreaterThanOrEqual(created_at" in plan.toString()
    df.collect()
    scan = plan.collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 4
    assert "hour" not in df.columns


def test_a_year_needs_a_listing_per_parent(spark, path, monkeypatch):
    rows = [(d, T0 + timedelta(days=d)) for d in range(4)]
    tables.replace_interval(events(spark, rows), path, HOURLY)
    calls, plain = [], storage.children
    monkeypatch.setattr(storage, "children", lambda s, p: calls.append(p) or plain(s, p))
    year = (T0.replace(hour=0), T0.replace(hour=0) + timedelta(days=365))
    assert ids(landing.read_landing(spark, path, iv=year)) == [0, 1, 2, 3]
    # The root, one year and one month: 8,760 hours cost three listings to find four days.
    assert len(calls) == 3
    calls.clear()
    tables.replace_interval(events(spark, rows[:1]), path, HOURLY, year)
    assert len(calls) == 3 + 4 and ids(landing.read_landing(spark, path)) == [0]


def test_plain_directory_tree(spark, path):
    events(spark, [(1, T0), (2, T0 + timedelta(days=1))]).write.parquet(f"{path}/2024/01/01/10")
    events(spark, [(3, T0)]).write.parquet(f"{path}/2024/01/03/10")
    df = landing.read_landing(spark, path, layout=PLAIN_HOURS, iv=("2024-01-01", "2024-01-02"))
    assert ids(df) == [1]
    assert ids(landing.read_landing(spark, path, layout=PLAIN_HOURS)) == [1, 2, 3]
    assert landing.read_landing(spark, path, iv=("2023-01-01", "2023-01-02")).isEmpty()
    found = files.partition_dates(files.list_files(spark, path)).collect()
    assert sorted(r.dt for r in found) == [date(2024, 1, 1), date(2024, 1, 3)]


def test_tenant_landing_in_one_scan(spark, path):
    base = HOURLY.assign(events(spark, [(1, T0)]), "created_at")
    both = base.withColumn("tenant", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))))
    both.write.partitionBy("tenant", *HOURLY.columns).parquet(path)
    iv = ("2024-01-01", "2024-01-02")
    df = landing.read_landing(spark, path, iv=iv, tenants=["a", "b"])
    assert sorted(r.tenant for r in df.collect()) == ["a", "b"]


def test_sorted_files(spark, path):
    rows = [(i, T0 + timedelta(seconds=(i * 37) % 100)) for i in range(100)]
    tables.replace_interval(events(spark, rows), path, DAILY)
    times = [r.created_at for r in spark.read.parquet(path).collect()]
    assert times == sorted(times)


def counts(spark, rows):
    return spark.createDataFrame(
        rows, "d DATE, kind STRING, n BIGINT, note STRING"
    )


def test_upsert_replaces_keeps_and_leaves_alone(spark, path):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    keys, part = ("d", "kind"), ("d",)
    first = counts(spark, [(d1, "a", 1, "x"), (d1, None, 2, "x"), (d2, "a", 3, "x")])
    second = counts(spark, [(d1, "a", 10, "y"), (d1, None, 20, "y"), (d1, "new", 30, "y")])
    tables.upsert_table(first, path, keys, part)
    before = set(files.list_files(spark, f"{path}/d=2024-01-02").toPandas().path)
    for _ in range(2):
        tables.upsert_table(second, path, keys, part, keep_cols=("note",))
        got = {(r.d, r.kind, r.n, r.note) for r in spark.read.parquet(path).collect()}
        assert got == {
            (d1, "a", 10, "x"),
            (d1, None, 20, "x"),
            (d1, "new", 30, "y"),
            (d2, "a", 3, "x"),
        }
    assert set(files.list_files(spark, f"{path}/d=2024-01-02").toPandas().path) == before
    with pytest.raises(ValueError):
        tables.upsert_table(first, path, ("kind",), part)


def test_kept_columns_keep_null(spark):
    d = date(2024, 1, 1)
    target = counts(spark, [(d, "a", 1, None)])
    got = tables.upsert(target, counts(spark, [(d, "a", 2, "y")]), ("d", "kind"), ("note",))
    assert [(r.n, r.note) for r in got.collect()] == [(2, None)]


def test_small_table_upsert_survives_a_cut_swap(spark, path):
    d = date(2024, 1, 1)
    tables.upsert_small_table(counts(spark, [(d, "a", 1, "")]), path, ("d", "kind"))
    # The swap stopped after the old version was moved away.
    retired = storage.retired(path)
    storage.move(spark, path, retired)
    schema = counts(spark, []).schema
    assert [r.kind for r in tables.read_or_empty(spark, path, schema).collect()] == ["a"]
    tables.upsert_small_table(counts(spark, [(d, "b", 2, "")]), path, ("d", "kind"))
    assert {r.kind for r in spark.read.parquet(path).collect()} == {"a", "b"}
    assert not storage.exists(spark, retired)


def test_insert_if_absent(spark, path):
    d = date(2024, 1, 1)
    target = counts(spark, [(d, "a", 1, ""), (d, None, 1, "")])
    src = counts(spark, [(d, "a", 9, ""), (d, None, 9, ""), (d, "b", 7, ""), (d, "b", 5, "")])
    got = tables.insert_if_absent(target, src, ("d", "kind"))
    assert {(r.kind, r.n) for r in got.collect()} == {("a", 1), (None, 1), ("b", 5)}
    for _ in range(2):
        tables.append_absent(src, path, ("d", "kind"), ("d",))
    stored = spark.read.parquet(path)
    assert {(r.kind, r.n) for r in stored.collect()} == {("a", 9), (None, 9), ("b", 5)}
    assert stored.count() == 3


def test_empty_window_is_replaced(spark, path):
    df = counts(spark, [(date(2024, 1, 1), "a", 1, "")])
    tables.replace_window(df, path, "w1")
    tables.replace_window(df, path, "w2")
    tables.replace_window(df.limit(0), path, "w1")
    assert [r.window for r in spark.read.parquet(path).collect()] == ["w2"]


def test_log_grows_and_archive_keeps_each_user_once_a_date(spark, path):
    df = counts(spark, [(date(2024, 1, 1), "a", 1, "")])
    users = [spark.createDataFrame([(u,)], "user_id STRING") for u in ("u1", "u1", "u2")]
    for user in users:
        tables.append_log(df, f"{path}/log")
        exports.archive(user, f"{path}/archive", "2024-01-31", "inactive_180d")
    exports.archive(users[0], f"{path}/archive", "2024-02-29", "inactive_180d")
    assert spark.read.parquet(f"{path}/log").count() == 3
    kept = spark.read.parquet(f"{path}/archive")
    assert sorted((str(r.archive_date), r.user_id) for r in kept.collect()) == [
        ("2024-01-31", "u1"), ("2024-01-31", "u2"), ("2024-02-29", "u1")
    ]
    assert {r.archive_reason for r in kept.collect()} == {"inactive_180d"}


def test_csv_and_republished_text(spark, path):
    df = counts(spark, [(date(2024, 1, 1), "a,b", 1, None)])
    exports.export_csv(df, f"{path}/csv")
    back = spark.read.option("header", True).schema(df.schema).csv(f"{path}/csv")
    assert [tuple(r) for r in back.collect()] == [(date(2024, 1, 1), "a,b", 1, None)]
    for _ in range(2):
        exports.republish(exports.message_values(df), "text", path=f"{path}/out")
    sent = [r.value for r in spark.read.text(f"{path}/out").collect()]
    assert sent == ['{"d":"2024-01-01","kind":"a,b","n":1,"note":null}'] * 2


def test_retention_deletes_only_expired_files(spark, path):
    tables.replace_interval(events(spark, [(1, T0), (2, T0 + timedelta(days=1))]), path, DAILY)
    plan = lifecycle.file_retention_plan(files.list_files(spark, path), "2000-01-01")
    assert lifecycle.apply_retention(plan, dry_run=False).filter("expired").isEmpty()
    assert ids(spark.read.parquet(path)) == [1, 2]
    later = lifecycle.file_retention_plan(files.list_files(spark, path), "2100-01-01")
    assert lifecycle.apply_retention(later).first().files == 2
    assert ids(spark.read.parquet(path)) == [1, 2]
    done = lifecycle.apply_retention(later, dry_run=False).first()
    assert (done.expired, done.files) == (True, 2)
    assert files.list_files(spark, path).isEmpty()


def test_compaction(spark, path):
    rows = [(i, T0 + timedelta(days=i % 2, seconds=i)) for i in range(400)]
    small = DAILY.assign(events(spark, rows), "created_at").repartition(10)
    small.write.partitionBy("dt").parquet(f"{path}/bronze")
    dates = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for target, expected in ((10**9, 1), (2000, None)):
        manifest = lifecycle.compact(spark, f"{path}/bronze", f"{path}/gold", dates, target)
        got = {r.compaction_date: r for r in manifest.collect()}
        assert set(got) == {date(2024, 1, 1), date(2024, 1, 2)}
        for r in got.values():
            assert (r.rows_before, r.rows_after, r.status) == (200, 200, "complete")
            assert r.files_before == 10
            assert r.files_after == expected or 1 < r.files_after <= r.files_before * 2
        stored = spark.read.parquet(f"{path}/gold")
        assert ids(stored) == list(range(400))
        names = [r.path for r in files.list_files(spark, f"{path}/gold").collect()]
        assert len(names) == sum(r.files_after for r in got.values())
        spans = stored.groupBy("dt", F.input_file_name().alias("file")).agg(
            F.min("created_at").alias("low"), F.max("created_at").alias("high")
        ).orderBy("dt", "low").collect()
        for one, two in zip(spans[:-1], spans[1:], strict=True):
            assert one.dt != two.dt or one.high < two.low
    nothing = lifecycle.compact(spark, f"{path}/bronze", f"{path}/gold", ["2023-01-01"])
    assert nothing.isEmpty()


def test_listing_and_footer(spark, path):
    tables.replace_interval(events(spark, [(1, T0)]), path, HOURLY)
    listed = files.list_files(spark, path)
    assert files.has_data(listed)
    newest = files.newest_file(listed)
    assert newest.endswith(".parquet")
    assert files.hour_of(files.newest_directory(spark, path)) == T0
    footer = files.schema_rows(files.read_footer_schema(spark, newest))
    kinds = {r.col_name: r.data_type for r in footer.collect()}
    assert kinds["created_at"] == "timestamp" and kinds["amount"] == "decimal(24,8)"


def test_manifest_keeps_its_order(spark, tmp_path):
    text = """[
      {"client_id": "beta", "schedule": "0 * * * *", "target_table": "t_b", "retention_days": 90},
      {"client_id": "alpha", "schedule": "0 * * * *", "target_table": "t_a", "retention_days": 30}
    ]"""
    (tmp_path / "tenants.json").write_text(text)
    rows = files.read_manifest(spark, f"file:{tmp_path}/tenants.json").orderBy("position").collect()
    assert [(r.client_id, r.retention_days) for r in rows] == [("beta", 90), ("alpha", 30)]


def test_tenant_gold_of_missing_directory(spark, path):
    manifest = spark.createDataFrame([("a",)], "client_id STRING")
    got = landing.read_tenant_gold(spark, f"{path}/absent", manifest).collect()
    assert [(r.tenant_id, r.total_conversions) for r in got] == [("a", 0)]


def test_bounded_dead_letter_batch(spark, path):
    rows = [(i % 3, i, f"m{i}") for i in range(30)]
    spark.createDataFrame(rows, schemas.DLQ_MESSAGES).write.json(path)
    some = messages.read_dlq(spark, "json", max_messages=12, path=path).collect()
    assert [(r.partition, r.offset) for r in some] == sorted((p, o) for p, o, _ in rows)[:12]
    assert messages.read_dlq(spark, "json", max_messages=None, path=path).count() == 30


def test_connector_options(spark):
    stream = messages.kafka_stream_options("h:1", "events", maxOffsetsPerTrigger="10")
    assert stream["startingOffsets"] == "latest" and stream["failOnDataLoss"] == "false"
    assert stream["subscribe"] == "events" and stream["maxOffsetsPerTrigger"] == "10"
    assert messages.kafka_batch_options("h:1", "dead")["startingOffsets"] == "earliest"
    read = jdbc.jdbc_options("jdbc:x", "t", "created_at", "a", "b", 7, fetchsize="100")
    assert (read["partitionColumn"], read["numPartitions"], read["fetchsize"]) == (
        "created_at",
        "7",
        "100",
    )


@pytest.mark.parametrize("time_name", ["created_at", "timestamp"])
def test_normalise_accepts_all_layouts(spark, time_name):
    nested = spark.createDataFrame(
        [(1, "u", "view", '{"product_id": "7", "amount": "1.2.3"}', T0)], schemas.LANDING_RAW
    )
    flat = spark.createDataFrame([("2", "u", "view", 8, T0)], schemas.LANDING_FLAT)
    got = [
        schemas.normalise(df.withColumnRenamed("created_at", time_name)).first()
        for df in (nested, flat)
    ]
    assert [(r.id, r.product_id, r.amount, r.created_at) for r in got] == [
        (1, 7, None, T0),
        (2, 8, None, T0),
    ]
    assert schemas.normalise(nested).schema == schemas.EVENTS


def test_source_keys_that_repeat_count_once(spark, path):
    old = counts(spark, [(date(2024, 1, 1), "a", 1, "old")])
    new = counts(spark, [(date(2024, 1, 1), "a", 3, "z"), (date(2024, 1, 1), "a", 2, "y")])
    got = tables.upsert(old, new, ("d", "kind")).collect()
    assert [(r.n, r.note) for r in got] == [(2, "y")]


def test_an_upsert_reads_only_the_dates_it_touches(spark, path):
    rows = [(date(2024, 1, d), "a", d, "") for d in range(1, 20)]
    tables.replace_partitions(counts(spark, rows), path, ("d",))
    src = counts(spark, [(date(2024, 1, 4), "a", 0, ""), (date(2024, 1, 6), "b", 0, "")])
    current = spark.read.schema(src.schema).parquet(path)
    df = tables.touched(current, src, ("d",))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [d" in plan and "2024-01-04" in plan and "2024-01-05" not in plan
    assert sorted(r.n for r in df.collect()) == [4, 6]


def test_a_second_with_most_rows_is_cut(spark, path):
    """Nine tenths of a date lie in one second; no file gets much more than its share."""
    rows = [(i, "u", "view", datetime(2024, 1, 1, 12) if i % 10 else datetime(2024, 1, 1) + timedelta(seconds=i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id BIGINT, user_id STRING, event_type STRING, created_at TIMESTAMP")
    DAILY.assign(df, "created_at").repartition(3).write.partitionBy("dt").parquet(f"{path}/bronze")
    size = sum(r.size for r in files.list_files(spark, f"{path}/bronze").collect())
    lifecycle.compact(spark, f"{path}/bronze", f"{path}/gold", ["2024-01-01"], size // 7)
    back = spark.read.parquet(f"{path}/gold").withColumn("file", F.col("_metadata.file_path"))
    counts = sorted(r["count"] for r in back.groupBy("file").count().collect())
    assert len(counts) >= 7 and counts[-1] < 2 * 4000 / 7
    assert sorted(r.id for r in back.collect()) == list(range(4000))
    # Files still follow one another in time.
    spans = sorted((r.a, r.b) for r in back.groupBy("file").agg(F.min("created_at").alias("a"), F.max("created_at").alias("b")).collect())
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_replayed_messages_carry_key_and_origin(spark):
    rows = [(3, 17, '{"user_id": "u1", "event_type": "view"}'), (0, 2, '{"userId": "u2"}'), (0, 3, '{"user_id": null}')]
    df = spark.createDataFrame(rows, "partition INT, offset BIGINT, fixed_value STRING")
    sent = exports.replayed(df, topic="main")
    got = {r.value: (r.key, {h.key: bytes(h.value) for h in r.headers}, r.topic) for r in sent.collect()}
    assert got[rows[0][2]] == ("u1", {"dlq_partition": b"3", "dlq_offset": b"17"}, "main")
    assert got[rows[1][2]][0] == "u2" and got[rows[2][2]][0] is None
    # The types that the sink asks for.
    kinds = {f.name: f.dataType.simpleString() for f in sent.schema.fields}
    assert kinds["headers"] == "array<struct<key:string,value:binary>>" and kinds["value"] == "string"
    options = exports.kafka_sink_options("b:1", "main", **{"kafka.linger.ms": "5"})
    assert options["kafka.acks"] == "all" and options["includeHeaders"] == "true" and options["topic"] == "main"


def test_a_local_scratch_folder_is_refused_on_a_cluster():
    from types import SimpleNamespace

    from tidemark import session

    def fake(master, **conf):
        context = SimpleNamespace(master=master, applicationId="app-1")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context)

    local = {"spark.sql.warehouse.dir": "file:/work/spark-warehouse"}
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_dir(fake(master, **local), "x")
        shared = session.scratch_dir(fake(master, **local, **{"spark.checkpoint.dir": "hdfs:///shared"}), "x")
        assert shared.startswith("hdfs:///shared/tidemark-app-1/x-")
    assert session.scratch_dir(fake("local[4]", **local), "x").startswith("file:/work/spark-warehouse/_scratch/")
    assert session.scratch_dir(fake("yarn", **{"spark.sql.warehouse.dir": "hdfs:///w"}), "x").startswith("hdfs:///w/_scratch")
