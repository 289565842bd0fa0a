"""Random inputs against plain Python."""

from __future__ import annotations

import json
import random
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.jsontext import add_fields, is_whole_object, object_fields
from tidemark.functions.numbers import mean2, pct2, per_unit2

CENT = Decimal("0.01")


def half_up(x: Decimal) -> float:
    return float(x.quantize(CENT, ROUND_HALF_UP))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(st.integers(0, 10**12), st.integers(0, 10**12)), min_size=1, max_size=200
    )
)
def test_percentages_are_exact(spark, pairs):
    pairs = [(min(p), max(p)) for p in pairs] + [(1, 800), (1, 3), (0, 0), (2, 3), (5, 1000)]
    df = spark.createDataFrame(pairs, "part BIGINT, total BIGINT")
    got = df.select("part", "total", pct2("part", "total").alias("p")).collect()
    for r in got:
        want = half_up(Decimal(r.part) * 100 / Decimal(r.total)) if r.total else None
        assert r.p == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.decimals(0, 10**9, places=8), min_size=1, max_size=50))
def test_means_are_exact(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "a DECIMAL(24,8)")
    totals = df.agg(F.sum("a").alias("s"), F.count("a").alias("n"))
    got = totals.select(mean2("s", "n").alias("m")).first().m
    assert got == half_up(sum(amounts, Decimal(0)) / len(amounts))
    none = df.limit(0).agg(F.sum("a").alias("s"), F.count("a").alias("n"))
    assert none.select(mean2("s", "n").alias("m")).first().m is None


def test_rate_per_minute(spark):
    df = spark.range(0, 2000).withColumn("r", per_unit2("id", 60))
    assert all(r.r == half_up(Decimal(r.id) / 60) for r in df.collect())


def strict(text: str):
    """The object in the text, or None; constants that JSON lacks are errors."""

    def refuse(name):
        raise ValueError(name)

    try:
        value = json.loads(text, parse_constant=refuse)
    except ValueError:
        return None
    return value if isinstance(value, dict) else None


def damaged(rng: random.Random) -> str:
    """A JSON object, mostly with a few characters removed, inserted or doubled."""

    def value(depth=0):
        kinds = [1, -2.5, "a", "}", "]", "{", '"', "\\", None, True, "é", "x\ty"]
        if depth < 2 and rng.random() < 0.4:
            if rng.random() < 0.5:
                return [value(depth + 1) for _ in range(rng.randint(0, 2))]
            return {rng.choice("abc"): value(depth + 1) for _ in range(rng.randint(0, 2))}
        return rng.choice(kinds)

    text = json.dumps({k: value() for k in rng.sample("abcdef", rng.randint(0, 3))})
    for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
        at = rng.randint(0, len(text))
        action = rng.random()
        if action < 0.3:
            text = text[:at] + text[at + 1 :]
        elif action < 0.8:
            extra = rng.choice(list("{}[],:\"' \n0\t\f") + ["{}", "}{", "],[", '"v":1', " ", "﻿"])
            text = text[:at] + extra + text[at:]
        else:
            text = text + rng.choice(["x", " ", "}", "]", text, "," + text, "], [" + text, "\f", "\u0085"])
    return text


def test_object_check_agrees_with_a_json_parser(spark):
    rng = random.Random(7)
    texts = sorted({damaged(rng) for _ in range(6000)})
    df = spark.createDataFrame([(t,) for t in texts], "v STRING")
    fields = df.select("v", F.explode(F.array(object_fields(F.col("v")))).alias("f"))
    got = fields.select(
        "v",
        is_whole_object(F.col("v"), F.col("f")).alias("ok"),
        F.map_keys("f").alias("keys"),
        add_fields(F.col("v"), F.lit(', "zz": null')).alias("more"),
    ).collect()
    accepted = 0
    for r in got:
        want = strict(r.v)
        assert r.ok == (want is not None), r.v
        if want is not None:
            accepted += 1
            assert set(r["keys"]) == set(want), r.v
            if want:
                assert strict(r.more) == {**want, "zz": None}, r.v
    assert 500 < accepted < len(texts) - 500
