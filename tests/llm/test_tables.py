"""Operators on vectors and conversations, SQL oracles, and the pipeline."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import numpy as np
import pytest
from tests.llm.brute import links, near_duplicates
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import covertree, minhash, preference, topk
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.storage import ship_package, stored


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(ORACLES[name])
    columns = [d[0] for d in want.description]
    expected = sorted(map(tuple, want.fetchall()))
    con.close()
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == expected and expected


VECTORS = "vec_id long, embedding array<float>, label int"


def odd_vectors():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 6))
    rows = [(i, [float(x) for x in centres[i % 4] + rng.normal(scale=0.25, size=6)], i % 2) for i in range(80)]
    rows += [(100 + i, rows[0][1], rows[0][2]) for i in range(5)]
    odd = [None, [], [0.0] * 6, [1.0, None, 1.0, 1.0, 1.0, 1.0], [math.nan] * 6, [math.inf] + [1.0] * 5, [1.0, 2.0], [2.0, 4.0],
           [1e-30] * 6, [1e30] * 6]
    rows += [(200 + i, v, 0) for i, v in enumerate(odd)]
    return rows + [(300, [1.0] * 6, None), (301, [1.0] * 6, None)]


@pytest.mark.parametrize("block", [7, 2048])
def test_links_of_odd_vectors(spark, block):
    rows = odd_vectors()
    df = spark.createDataFrame(rows, VECTORS)
    df = df.select("*", *(F.lit(1).alias(c) for c in ("others", "id", "KEPT", "class", "copies")))
    found = covertree.link_vectors(df, block=block)
    got = sorted(tuple(r) for r in found.select("vec_id", "n_links", "component_id").collect())
    # Single precision values, as the table holds them.
    held = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], k) for i, v, k in rows]
    assert got == links(held, 0.93) and any(r[1] for r in got)
    assert found.where("kept <> (vec_id = component_id)").isEmpty()
    assert {"others", "id", "class", "copies"} <= set(found.columns)


def test_links_of_empty_table_and_missing_ids(spark):
    assert covertree.link_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    null = spark.createDataFrame([(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (4, [1.0, 2.0], 1)], VECTORS)
    got = covertree.link_vectors(null).select("vec_id", "n_links", "component_id", "kept").collect()
    assert sorted(tuple(r) for r in got if r[0]) == [(4, 0, 4, True)]
    assert [tuple(r) for r in got if not r[0]] == [(None, 0, None, True)] * 2


def test_trees_are_nested_and_find_every_pair():
    rng = np.random.default_rng(5)
    x = np.concatenate([c + rng.normal(scale=s, size=(120, 5)) for c in rng.normal(size=(4, 5)) for s in (0.02, 0.3)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    one, two = covertree.Tree(x[:500], leaf=4), covertree.Tree(x[500:], leaf=4)
    start, stop, child, end = one.nodes
    for i in range(len(start)):
        own = one.points[start[i] : stop[i]]
        assert np.linalg.norm(own - own[0], axis=1).max() == pytest.approx(one.radius[i], abs=1e-12)
        if child[i] < end[i]:
            kids = slice(child[i], end[i])
            assert start[kids][0] == start[i] and stop[kids][-1] == stop[i]
            centres = one.points[start[kids]]
            away = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(centres)) * 9
            assert away.min() > one.radius[i] / 2
    for a, b in ((one, two), (one, one)):
        found = [(i, j) for x, y in covertree.near_pairs(a, b, 0.93, direct=30) for i, j in zip(x, y, strict=True)]
        got = set(found)
        assert len(got) == len(found)
        want = {(i, j) for i, j in np.argwhere(a.points @ b.points.T >= 0.93) if a is not b or i < j}
        assert got == want and want


def test_top_k_of_odd_vectors(spark):
    rows = odd_vectors() + [(None, [1.0] * 6, 1), (0, [5.0] * 6, 1)]
    df = spark.createDataFrame(rows, VECTORS).select("*", F.lit(1).alias("weights"), F.lit(2).alias("block"))
    found = topk.top_k(df, F.col("vec_id") % 50 == 0, k=7)
    got = sorted(tuple(r) for r in found.collect())
    usable = []
    for i, v, _ in rows:
        v = None if v is None else [None if x is None else float(np.float32(x)) for x in v]
        if i is not None and v is not None and None not in v and np.isfinite(v).all():
            usable.append((i, [max(-(2**63), min(2**63 - 1, math.floor(1024 * x))) for x in v]))
    # A repeated query keeps one of its rows; leave it out here.
    want = []
    for i, q in usable:
        if i % 50 == 0 and i != 0:
            scores = [(-((sum(a * b for a, b in zip(q, c)) + 2**63) % 2**64 - 2**63), j) for j, c in usable if j != i]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:7])]
    assert [r for r in got if r[0] != 0] == sorted(want)
    assert sum(r[0] == 0 for r in got) == 7 and all(r[2] != 0 for r in got if r[0] == 0)
    assert topk.top_k(spark.createDataFrame([], VECTORS), F.lit(True)).count() == 0


def test_preference_records_of_odd_turns(spark):
    turns = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "yes é"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"),
        (2, 0, None, None), (2, 1, "user", ""), (3, 0, None, None), (4, 0, "user", "x"), (5, 0, "user", "x"),
        (None, 0, "user", "x"), (6, 1, "user", "b"), (6, 1, "user", "a"), (6, None, "assistant", "first"), (7, 3, "user", "z"),
    ]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    convs = preference.conversations(df.withColumn("turns", F.lit(1)).withColumn("prompt", F.lit(2)))
    pairs = spark.createDataFrame(
        [(0, 0, 1), (1, 2, 3), (2, 4, 5), (3, 6, 7), (4, 8, 0), (0, 0, 1)], "pair_id long, chosen_id long, rejected_id long"
    )
    found = preference.preference_records(convs, pairs).orderBy("pair_id").collect()
    assert [r["pair_id"] for r in found] == [0, 0, 1, 2, 3]
    one = found[0]
    assert (one["prompt"], one["prompt_turns"]) == ("<|user|>\nhi<|end|>\n", 1)
    assert one["chosen"] == "<|assistant|>\nyes é<|end|>\n" and one["chosen_mask"] == "14:26"
    assert one["chosen"][14:26] == "yes é<|end|>" and one["rejected_mask"] == "14:23"
    prefix, equal, ordered = found[2], found[3], found[4]
    assert prefix["prompt"] == "<|unknown|>\n<|end|>\n" and prefix["rejected"] == "" and prefix["chosen_mask"] == ""
    assert equal["chosen"] == equal["rejected"] == "" and equal["prompt_turns"] == 1
    assert ordered["prompt_turns"] == 0 and ordered["chosen"].index("first") < ordered["chosen"].index("\na<")
    assert preference.preference_records(preference.conversations(df.limit(0)), pairs).count() == 0


def test_preference_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["op2_preference_format"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    out = {"documents": spark.read.parquet(f"{sf_dir}/documents.parquet")}
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stored(stage(spark, docs, sf_dir), name)
    return out


def test_pipeline_stages(spark, sf_dir, stages):
    columns = stages["documents"].columns
    for name in ("language_id", "near_dedup", "secret_scan", "source_mixing"):
        assert stages[name].columns == columns and not stages[name].isEmpty()
    docs = {r["doc_id"]: r["text"] for r in stages["documents"].collect()}
    first = {r["doc_id"] for r in stages["language_id"].collect()}
    assert first == {i for i, t in docs.items() if any(map(str.isalpha, t or ""))}
    kept = {r["doc_id"] for r in stages["near_dedup"].collect()}
    found = minhash.near_duplicates(stages["language_id"]).select("doc_id", "component_id").collect()
    assert kept == {r["component_id"] for r in found}
    clean = {r["doc_id"]: r for r in stages["secret_scan"].collect()}
    assert clean.keys() == kept and any("[SECRET]" in r["text"] for r in clean.values())
    assert all(r["text"] == docs[i] or "[SECRET]" in r["text"] for i, r in clean.items())
    mixed = [r["doc_id"] for r in stages["source_mixing"].collect()]
    assert set(mixed) <= kept and len(mixed) > 0.9 * len(kept)
    packed = stages["best_fit_packing"].toPandas()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
    assert sorted(packed[packed["start"] == 0]["doc_id"]) == sorted(mixed)


def test_pipeline_on_odd_and_empty_tables(spark, odd_docs, no_docs, odd_rows):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, ""), name)
        docs.count()
    doubled = odd_docs.union(odd_docs)
    kept = corpus_pipeline.near_dedup(spark, doubled, "").select("doc_id").collect()
    want = {low for _, _, low in near_duplicates([r[:2] for r in odd_rows])}
    assert sorted(r[0] for r in kept) == sorted(want)


def test_of_rows_that_repeat_an_id_the_first_text_stays(spark):
    texts = ["second unrelated text of this id", "first of all texts", "third text", "first of all texts"]
    rows = [(5, t, "en", s, len(t)) for t, s in zip(texts, "cabd", strict=True)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, schema).repartition(2)
        got = [tuple(r) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
        assert got == [(5, "first of all texts", "en", "a", 18)]
