"""Types of nested payloads against a plain walk over the parsed JSON."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timedelta

from tidemark.operators import payloads

T0 = datetime(2024, 1, 1)
SCHEMA = "payload STRING, created_at TIMESTAMP"

TEXTS = [
    '{"a": 1, "b": {"c": "x", "d": {"e": 1.5, "f": [1, 2]}}}',
    '{"a": "1", "b": {"c": null, "d": {"e": 2, "f": ["x"]}}}',
    '{"a": true, "b": 7, "odd.key": {"x y": 1}}',
    '{"b": {"d": {"deeper": {"still": {"on": false}}}}}',
    "[1, 2]", "3", '"text"', "null", "{}", '{"a": {}}',
    "{", "", None, "not json",
]


def kind(value):
    if value is None:
        return "VOID"
    if isinstance(value, dict):
        return "OBJECT"
    names = {bool: "BOOLEAN", int: "BIGINT", float: "DECIMAL", str: "STRING"}
    if isinstance(value, list):
        inner = {kind(v) for v in value}
        return f"ARRAY<{inner.pop()}>" if len(inner) == 1 else "ARRAY<VARIANT>"
    return names[type(value)]


def walk(path, value):
    yield path, kind(value)
    if isinstance(value, dict):
        for key, below in value.items():
            step = f".{key}" if key.isidentifier() else f"['{key}']"
            yield from walk(path + step, below)


def expected(rows):
    out = Counter()
    for text, when in rows:
        day = datetime(when.year, when.month, when.day) if when else None
        if text is None:
            out[day, "$", "VOID"] += 1
            continue
        try:
            value = json.loads(text)
        except ValueError:
            out[day, "$", "INVALID"] += 1
            continue
        for path, name in walk("$", value):
            out[day, path, name] += 1
    return out


def test_types_of_every_path(spark):
    rows = [(t, T0 + timedelta(hours=7 * i)) for i, t in enumerate(TEXTS * 3)] + [(TEXTS[0], None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = payloads.payload_types(df)
    got = {(r.window_start, r.path, r.type): r.rows for r in found.collect()}
    assert got == dict(expected(rows))


def test_flat_payloads_are_scanned_once(spark, monkeypatch):
    df = spark.createDataFrame([('{"a": 1}', T0)], SCHEMA)
    levels = []
    held = payloads._level
    monkeypatch.setattr(payloads, "_level", lambda p, d: levels.append(d) or held(p, d))
    assert payloads.payload_types(df).count() == 2 and levels == [1]
    assert payloads.payload_types(df.limit(0)).isEmpty()


def test_drift_names_each_kind(spark):
    rows = [(t, T0) for t in TEXTS]
    types = payloads.payload_types(spark.createDataFrame(rows, SCHEMA))
    wanted = {"$.a": "BIGINT", "$.b.c": "STRING", "$.b.d.e": "DECIMAL", "$.z.y": "STRING"}
    assert payloads.with_parents(wanted) == {
        "$": "OBJECT", "$.b": "OBJECT", "$.b.d": "OBJECT", "$.z": "OBJECT", **wanted
    }
    found = payloads.payload_path_drift(types, wanted)
    got = {(r.path, r.expected_type, r.actual_type, r.status): r.rows for r in found.collect()}
    n = len(TEXTS)
    assert got[("$.a", "BIGINT", "STRING", "type_mismatch")] == 1
    assert got[("$.a", "BIGINT", "BOOLEAN", "type_mismatch")] == 1
    assert got[("$.a", "BIGINT", None, "missing")] == n - 4
    assert got[("$.b", "OBJECT", "BIGINT", "type_mismatch")] == 1
    assert got[("$.b.c", "STRING", "VOID", "null")] == 1
    assert got[("$.b.d.e", "DECIMAL", "BIGINT", "type_mismatch")] == 1
    assert got[("$.b.d.f", None, "ARRAY<BIGINT>", "extra")] == 1
    assert got[("$['odd.key']['x y']", None, "BIGINT", "extra")] == 1
    assert got[("$.z.y", "STRING", None, "missing")] == got[("$.z", "OBJECT", None, "missing")] == n
    assert got[("$", "OBJECT", "INVALID", "type_mismatch")] == 3
    assert not any(k[0] == "$" and k[3] == "missing" for k in got)
    assert payloads.payload_path_drift(types.limit(0), wanted).isEmpty()
