"""Benchmark decontamination against plain Python."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tests.llm.brute import contamination as brute
from tests.llm.brute import plain_words

from tidemark.llm import decontaminate
from tidemark.llm.queries import QUERIES

ITEMS = "item_id long, text string"


def words(rng, n):
    return [rng.choice(["Ab", "cé", "d1", "E", "été", "x"]) + str(rng.randint(0, 9)) for _ in range(n)]


@pytest.fixture(scope="module")
def items():
    rng = random.Random(3)
    texts = [" ".join(words(rng, n)) for n in (10, 11, 30, 60, 3, 1)]
    # Two items share a passage, one is repeated, and some have no word at all.
    texts += [texts[3] + " and more, words", texts[2], "", " -- !! ", None, "One; two\tTHREE"]
    return [*enumerate(texts), (2, texts[2]), (None, " ".join(words(rng, 12)))]


@pytest.fixture(scope="module")
def rows(items):
    rng = random.Random(4)
    texts = [t for _, t in items if t]
    out = [None, "", "...", "one two three", "ONE,two...three", " ".join(words(rng, 9))]
    for t in texts:
        w = t.split()
        out += [
            t.upper(), f"({t})", " ".join([*words(rng, 20), *w, *words(rng, 5), *w[:10], *w[1:]]),
            "-".join(w[:9]), "\n".join(w[-10:]), f"é{t}", f"{t}1", " . ".join(w[5:18] * 3),
        ]
    out += ["é Ü " * 30_000 + texts[3], " ".join(words(rng, 300))]
    return [(i if i != 7 else None, t) for i, t in enumerate(out)] + [(4, out[4]), (4, texts[0]), (4, texts[0])]


def as_brute(found):
    got = [
        (r.doc_id, r.n_words, [p for s in r.spans for p in range(s.start, s.stop)], r.n_hit, r.n_items, r.items_sha256)
        for r in found.collect()
    ]
    return sorted(got, key=repr)


def expected(rows, items, width=10):
    return sorted(
        (
            (i, n, hit, len(hit), len(named), hashlib.sha256(",".join(named).encode()).hexdigest())
            for i, n, hit, named in brute(rows, items, width)
        ),
        key=repr,
    )


@pytest.mark.parametrize(("width", "sent"), [(10, 1 << 26), (10, 500), (3, 1 << 26), (1, 1 << 26)])
def test_equals_plain_python(spark, rows, items, width, sent):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("*", *(F.lit(7).alias(c) for c in ("doc", "row_key", "WORDS", "key", "at", "items")))
    bench = spark.createDataFrame(items, ITEMS).select("*", F.lit(1).alias("gram"), F.lit(1).alias("item"))
    found = decontaminate.contamination(docs, bench, width, sent=sent)
    assert as_brute(found) == expected(rows, items, width)
    assert found.where("contaminated <> (n_hit > 0)").isEmpty() and not found.where("contaminated").isEmpty()


def test_empty_tables(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], ITEMS)
    assert as_brute(decontaminate.contamination(docs, none)) == expected(rows, [])
    bench = spark.createDataFrame(items, ITEMS)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(docs, none).exceptAll(docs).isEmpty()


def test_spans_or_documents_are_removed(spark, rows, items):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("text", "doc_id", *(F.lit(7).alias(c) for c in ("row", "found", "row_key", "spans")))
    bench = spark.createDataFrame(items, ITEMS)
    hit = {(i, n, tuple(h)) for i, n, h, _ in brute(rows, items)}
    cut = decontaminate.decontaminate(docs, bench)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    # What is left is the document's words without those hit, and texts without a hit are whole.
    left = sorted(((r.doc_id, tuple(plain_words(r.text))) for r in cut.collect()), key=repr)
    want = []
    for i, t in rows:
        w = plain_words(t)
        gone = next(h for j, n, h in hit if j == i and n == len(w) and all(k < n for k in h) and brute([(i, t)], items)[0][2] == list(h))
        want.append((i, tuple(x for k, x in enumerate(w) if k not in set(gone))))
    assert left == sorted(want, key=repr)
    dropped = decontaminate.decontaminate(docs, bench, by="documents")
    clean = [(i, t) for i, t in rows if not brute([(i, t)], items)[0][2]]
    assert sorted(map(repr, clean)) == sorted(repr((r.doc_id, r.text)) for r in dropped.collect())
    with pytest.raises(ValueError):
        decontaminate.decontaminate(docs, bench, by="words")


def test_plan_has_no_python_and_one_scan(spark, sf_dir):
    plan = QUERIES["op13_decontaminate"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
    assert plan.count("documents.parquet") == 1 and "BroadcastHashJoin" in plan
