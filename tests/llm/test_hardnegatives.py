"""Hard negatives against plain integers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.brute import hard_negatives as brute

from tidemark.llm import hardnegatives
from tidemark.llm.storage import ship_package

SCHEMA = "vec_id long, embedding array<double>, label int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def odd_rows():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 6)) * 0.3
    rows = [
        (i, [float(x) for x in centres[i % 5] + rng.normal(scale=0.1, size=6)], (i // 5) % 3)
        for i in range(150)
    ]
    # Ties, repeated ids and rows, odd vectors, missing labels and ids.
    rows += [(200 + i, rows[0][1], i % 2) for i in range(9)]
    rows += [(210, [0.5] * 6, 0), (210, [0.25] * 6, 0), (210, [0.25] * 6, 0), (0, [0.1] * 6, 2)]
    odd = [None, [], [0.0] * 6, [1.0, None, 1.0], [math.nan] * 6, [math.inf] + [1.0] * 5, [1.0, 2.0], [1.0] * 8]
    rows += [(220 + 10 * i, v, i % 2) for i, v in enumerate(odd)]
    return [*rows, (300, [1.0] * 6, None), (None, [1.0] * 6, 1)]


@pytest.mark.parametrize("most", [4, 40, 32768])
def test_equals_plain_integers(spark, most):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    df = df.select("*", *(F.lit(1).alias(c) for c in ("id", "block", "weights", "PARTS", "rank", "score")))
    found = hardnegatives.hard_negatives(df, F.col("vec_id") % 10 == 0, most=most)
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute(rows, lambda i: i % 10 == 0) and len({r[0] for r in got}) > 10


def test_one_label_empty_table_and_no_anchor(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0], 1) for i in range(30)], SCHEMA)
    assert hardnegatives.hard_negatives(df, F.col("vec_id") % 10 == 0).isEmpty()
    assert hardnegatives.hard_negatives(df.limit(0), F.lit(True)).isEmpty()
    other = df.withColumn("label", F.col("vec_id").cast("int"))
    assert hardnegatives.hard_negatives(other, F.lit(True)).isEmpty()
    assert hardnegatives.hard_negatives(df, F.lit(False)).isEmpty()


@pytest.mark.parametrize("high", [1, 2, 300, 1 << 14, 1 << 29, 1 << 40])
@pytest.mark.parametrize("shift", [0, -1, 1])
def test_fields_give_exact_products(high, shift):
    rng = np.random.default_rng(high)
    a = rng.integers(-high, high + 1, size=(7, 5)) + shift * high
    c = rng.integers(-high, high + 1, size=(41, 5)) + shift * high
    a[0], c[0] = high * (1 + shift), high * (1 + shift)
    got = np.concatenate([t for _, t in hardnegatives.tables(a, c)])
    want = a.astype(object) @ c.astype(object).T
    bound = (1 << 63) - 1
    assert (got.astype(object) == np.clip(want, -bound, bound)).all()


def test_several_candidates_share_a_word():
    rng = np.random.default_rng(1)
    c = rng.integers(-150, 150, size=(1000, 64))
    packed = hardnegatives.Packed(c, -150, 150)
    assert packed.packed.dtype == np.uint64 and packed.packed.shape == (64, 500)
    wide = hardnegatives.Packed(c << 20, -150, 150)
    assert wide.packed.dtype == object and wide.packed.shape[1] == -(-1000 // hardnegatives.FIELDS)
