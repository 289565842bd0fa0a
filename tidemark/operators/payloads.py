"""Types of nested payload fields, and their drift from what is expected.

A payload is read as a variant. Each scan goes one level of objects deeper than the one before
and counts, per bucket, path and type, the rows that have it; the scans end when a level holds
no more objects, so there are as many as the payloads are deep. Counting is combined on the map
side, and what is stored has one row per bucket, path and type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.intervals import bucket_start
from tidemark.session import scratch_dir

OBJECT, INVALID, NULL = "OBJECT", "INVALID", "VOID"
_CHILDREN = "map<string, variant>"


def type_name(value: Column) -> Column:
    """Type of a variant: OBJECT for any object, DECIMAL of any precision, ARRAY<...> whole."""
    plain = F.regexp_replace(F.schema_of_variant(value), r"\(\d+,\d+\)", "")
    return F.regexp_replace(plain, "^OBJECT<.*$", OBJECT)


def _step(key: Column) -> Column:
    plain = key.rlike("^[A-Za-z_][A-Za-z0-9_]*$")
    return F.when(plain, F.concat(F.lit("."), key)).otherwise(
        F.concat(F.lit("['"), key, F.lit("']"))
    )


def _children(path: Column, value: Column) -> Column:
    """(path, value) of the fields of an object; none for any other value."""
    fields = F.map_entries(F.try_variant_get(value, "$", _CHILDREN))
    return F.transform(
        F.coalesce(fields, F.array().cast("array<struct<key: string, value: variant>>")),
        lambda f: F.named_struct(
            F.lit("path"), F.concat(path, _step(f["key"])), F.lit("value"), f["value"]
        ),
    )


def _level(payload: Column, depth: int) -> Column:
    """(path, value) of all fields `depth` objects below the root."""
    found = _children(F.lit("$"), payload)
    for _ in range(depth - 1):
        found = F.flatten(F.transform(found, lambda f: _children(f["path"], f["value"])))
    return found


def payload_types(
    events: DataFrame,
    every: str = "1 day",
    time_col: str = "created_at",
    payload_col: str = "payload",
) -> DataFrame:
    """(window_start, path, type, rows): how many rows of a bucket have a type at a path.

    The root is `$`, of type INVALID where the text is not JSON and VOID where it is NULL. A
    JSON null is VOID. Arrays are types of their own and not entered; of a repeated key the
    parser's choice counts.
    """
    window = bucket_start(time_col, every).alias("window_start")
    # A generated column is not inlined, so each text is parsed once in a scan.
    parsed = events.select(
        window,
        F.col(payload_col).isNull().alias("_null"),
        F.explode(F.array(F.try_parse_json(payload_col))).alias("_payload"),
    )
    payload = F.col("_payload")
    root = F.when(F.col("_null"), NULL).when(payload.isNull(), INVALID).otherwise(type_name(payload))
    spark, folder, depth = events.sparkSession, scratch_dir(events.sparkSession, "payloads"), 1
    while True:
        fields = F.transform(
            _level(payload, depth),
            lambda f: F.named_struct(F.lit("path"), f["path"], F.lit("type"), type_name(f["value"])),
        )
        if depth == 1:
            own = F.array(F.named_struct(F.lit("path"), F.lit("$"), F.lit("type"), root))
            fields = F.concat(own, fields)
        counted = (
            parsed.select("window_start", F.explode(fields).alias("_f"))
            .groupBy("window_start", F.col("_f.path").alias("path"), F.col("_f.type").alias("type"))
            .agg(F.count(F.lit(1)).alias("rows"))
        )
        counted.write.parquet(f"{folder}/depth={depth}")
        stored = spark.read.schema(counted.schema).parquet(f"{folder}/depth={depth}")
        if stored.filter((F.col("type") == OBJECT) & (F.col("path") != "$")).isEmpty():
            break
        depth += 1
    return spark.read.schema(counted.schema).parquet(
        *(f"{folder}/depth={d}" for d in range(1, depth + 1))
    )


def with_parents(expected: dict[str, str]) -> dict[str, str]:
    """The expected types with the objects that their paths lead through."""
    full = {"$": OBJECT}
    for path in expected:
        parts = path.split(".")
        for end in range(2, len(parts)):
            full[".".join(parts[:end])] = OBJECT
    return full | expected


def payload_path_drift(types: DataFrame, expected: dict[str, str]) -> DataFrame:
    """(window_start, path, expected_type, actual_type, rows, status) of what is not expected.

    `types` is the result of `payload_types`, `expected` the type of each path; the objects
    they lie in are expected too. Status: `type_mismatch`; `null` for a JSON null; `extra` for
    a path that is not expected; `missing` with the rows that lack an expected path.
    """
    spark = types.sparkSession
    wanted = spark.createDataFrame(
        list(with_parents(expected).items()), "path STRING, expected_type STRING"
    )
    totals = types.filter("path = '$'").groupBy("window_start").agg(F.sum("rows").alias("total"))
    # One row per bucket and expected path.
    pairs = totals.select(
        "window_start",
        "total",
        F.explode(F.array(*(F.lit(p) for p in sorted(with_parents(expected))))).alias("path"),
    )
    present = types.groupBy("window_start", "path").agg(F.sum("rows").alias("present"))
    same = ["window_start", "path"]
    lacking = pairs.alias("p").join(
        present.alias("f"), [F.col(f"p.{c}").eqNullSafe(F.col(f"f.{c}")) for c in same], "left"
    )
    missing = lacking.select(
        "p.window_start", "p.path", F.lit(None).cast("string").alias("actual_type"),
        (F.col("total") - F.coalesce("present", F.lit(0))).alias("rows"),
    ).filter("rows > 0")
    found = types.select("window_start", "path", F.col("type").alias("actual_type"), "rows")
    actual, expected_type = F.col("actual_type"), F.col("expected_type")
    status = (
        F.when(expected_type.isNull(), "extra")
        .when(actual.isNull(), "missing")
        .when(actual == NULL, "null")
        .when(actual != expected_type, "type_mismatch")
    )
    return (
        found.unionByName(missing)
        .join(wanted, "path", "left")
        .withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select("window_start", "path", "expected_type", "actual_type", "rows", "status")
    )
