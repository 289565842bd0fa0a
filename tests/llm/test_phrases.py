"""Collocations against plain counting, and the parse they are counted in."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests.llm.brute import collocations as brute

from tidemark.llm import phrases
from tidemark.llm.storage import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def odd_rows():
    rng = random.Random(6)
    common = ["new york", "a b c d e", "é Ö x", "x\x0by z", "the", "of the", " q q"]
    rare = [f"w{i}" for i in range(400)]

    def text(n):
        parts = [rng.choice(common) if rng.random() < 0.5 else rng.choice(rare) for _ in range(n)]
        return "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "!?", ",", ":;"]) for p in parts)

    copies = text(80)
    texts = [None, "", " \t ", "...\n", "one", "New York", copies, copies, copies.upper(), f"{copies} {copies}"]
    texts += [text(rng.randint(1, 300)) for _ in range(40)] + [text(20_000), "a " * 5000, "b.b.b " * 300]
    langs = ["en", "de", None, "und", "fr"]
    rows = [(langs[i % 5] if i < 48 else "en", t) for i, t in enumerate(texts)]
    return rows + [("zz", "no more")]


@pytest.mark.parametrize(
    ("width", "least", "first", "mark", "bits", "absorb"),
    [(5, 3, 2000, 32, 1 << 26, 100), (5, 2, 2000, 1, 1 << 15, 100), (3, 4, 7, 5, 1 << 20, 60), (2, 1, 50, 1 << 30, 1 << 15, 100)],
)
def test_equals_plain_counting(spark, width, least, first, mark, bits, absorb):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    docs = docs.select("*", *(F.lit(1).alias(c) for c in ("chunk", "n", "PHRASE", "f", "rank", "doc_id")))
    found = phrases.collocations(docs, width, least, first, absorb, mark=mark, bits=bits)
    got = sorted(tuple(r) for r in found.collect())
    assert got == brute(rows, width, least, first, absorb) and len(got) > 20


def test_empty_tables_and_no_words(spark):
    docs = spark.createDataFrame([("en", None), ("en", ""), (None, " . ")], "lang string, text string")
    assert phrases.collocations(docs).isEmpty()
    assert phrases.collocations(docs.limit(0)).isEmpty()


def test_products_beyond_64_bits(spark):
    # a n is about 2^61 here, and 1000 a n needs more than 64 bits.
    grams = spark.createDataFrame(
        [("en", "a", 1, 3 << 30), ("en", "b", 1, 5 << 30), ("en", "a b", 2, 1 << 30)],
        "lang string, phrase string, size int, f long",
    )
    total = spark.createDataFrame([("en", (1 << 40) + 7)], "lang string, n long")
    held = phrases.phrase_counts
    phrases.phrase_counts = lambda *_: (grams, total)
    try:
        row = phrases.collocations(grams).first()
    finally:
        phrases.phrase_counts = held
    assert row.score == 1000 * (1 << 30) * ((1 << 40) + 7) // ((3 << 30) * (5 << 30))


@pytest.mark.parametrize("mark", [1, 2, 7, 1 << 40])
def test_chunks_overlap_and_own_each_word_once(mark):
    texts = [t for _, t in odd_rows()]
    rows, chunks, last = phrases.parse(pa.array(texts, pa.string()), 5, mark)
    owned = {}
    for row, chunk, end in zip(rows.tolist(), chunks.to_pylist(), last.tolist(), strict=True):
        words = re.findall(r"[^ \n]+", chunk)
        own = owned.setdefault(row, [])
        # The overlap that the chunk before has left open is how this one begins.
        assert own[-1][1][: len(words)] == words[:4] if own and own[-1][1] else True
        own.append((words if end else words[:-4], [] if end else words[-4:]))
    for i, text in enumerate(texts):
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^ \t.,;:!?\n\x0b\x0c\r]+", lowered)
        assert [w for part, _ in owned.get(i, []) for w in part] == words


def test_equal_passages_give_equal_chunks():
    rng = random.Random(1)
    passage = " ".join(rng.choice("abcdefghij") for _ in range(2000))
    _, chunks, _ = phrases.parse(pa.array([f"x y {passage} z", f"{passage} q", "p " + passage]), 5, 32)
    assert len(set(chunks.to_pylist())) < 0.45 * len(chunks)
