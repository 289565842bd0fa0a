"""Language ID and source mixing of the whole small table, worked out without the library."""

from __future__ import annotations

import math
import re
import struct
from collections import Counter, defaultdict
from zlib import crc32

import pyarrow.parquet as pq
import pytest
import xxhash

from tidemark.llm import mixing
from tidemark.llm.queries import QUERIES
from tidemark.llm.storage import ship_package

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="module")
def table(sf_dir):
    return pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()


# -- language ID: plain sets of n-grams instead of bit-sliced filters ---------


def grams(text):
    shown = bytes(
        b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in (text or "").encode()
    )
    shown = b" " + shown + b" "
    windows = (shown[i : i + 4] for i in range(len(shown) - 3))
    return [w for w in windows if b"  " not in w]


def learned(rows, most=20_000, share=0.2):
    counts = defaultdict(Counter)
    for text, lang in rows:
        counts[lang].update(grams(text))
    shares = {}
    for lang, found in counts.items():
        # Ties at the end of the list go to the smaller n-gram.
        top = sorted(found.items(), key=lambda x: (-x[1], x[0]))[:most]
        total = sum(n for _, n in top)
        shares[lang] = {g: n / total for g, n in top}
    best = Counter()
    for own in shares.values():
        for g, s in own.items():
            best[g] = max(best[g], s)
    return {lang: {g for g, s in own.items() if s >= share * best[g]} for lang, own in shares.items()}


def test_languages_equal_those_of_plain_sets(spark, sf_dir, table):
    held = {r["doc_id"]: crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in table}
    sets = learned([(r["text"], r["lang"]) for r in table if not held[r["doc_id"]] and r["lang"] and r["text"] is not None])
    got = {r.doc_id: r for r in QUERIES["op10_language_id"](spark, sf_dir).collect()}
    assert got.keys() == held.keys()
    right = judged = close = 0
    for row in table:
        own, found = grams(row["text"]), got[row["doc_id"]]
        assert found.held_out == held[row["doc_id"]]
        if not any(map(str.isalpha, row["text"] or "")):
            assert (found.lang_pred, found.score) == ("und", 0.0)
            continue
        scores = {lang: sum(g in s for g in own) / len(own) for lang, s in sets.items()}
        first, *rest = sorted(scores, key=lambda x: (-scores[x], x))
        # The filters' false positives are counted out of a share, which leaves a little noise.
        close += abs(found.score - scores[first]) < 0.02
        judged += 1
        if scores[first] - scores[rest[0]] > 0.05:
            assert found.lang_pred == first
        right += found.lang_pred == row["lang"] or not held[row["doc_id"]]
    assert judged > 0.9 * len(table) and close > 0.99 * judged and right > 0.97 * judged


# -- mixing: exponent, quotas and drawn rows in plain Python ------------------


def spark_hash(*values):
    """Spark's xxhash64 of longs, ints (as 'i', n), strings and booleans."""
    seed = 42
    for v in values:
        if v is None:
            continue
        if isinstance(v, str):
            raw = v.encode()
        elif isinstance(v, bool):
            raw = struct.pack("<i", v)
        elif isinstance(v, tuple):
            raw = struct.pack("<i", v[1])
        else:
            raw = struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def bisect(test):
    """The largest x in [0, 1] for which a falling test holds."""
    low, high = 0.0, 1.0
    if test(1.0):
        return 1.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if test(middle) else (low, middle)
    return low


def mixed(rows, budget, entropy, repeats, block):
    """({source: weight}, {(doc_id, epoch)}) of (doc_id, source, text) rows with an id each."""
    docs = [(i, s, len(WORD.findall(t or "")), spark_hash(i, t, ("i", 0))) for i, s, t in rows]
    docs = [d for d in docs if d[2]]
    tokens = Counter()
    for _, source, n, _ in docs:
        tokens[source] += n
    total = sum(tokens.values())

    def weights(x):
        raw = {s: (t / total) ** x for s, t in tokens.items()}
        z = sum(raw.values())
        return {s: r / z for s, r in raw.items()}

    def flat(x):
        w = weights(x).values()
        return -sum(p * math.log(p) for p in w) >= entropy * math.log(len(w)) - 1e-12

    def often(x):
        return any(w * budget * total > repeats * tokens[s] for s, w in weights(x).items())

    x = bisect(flat) if len(tokens) > 1 else 1.0
    if often(x) and budget <= repeats:
        steep = bisect(often)
        x = max(x, steep)
    elif often(x):
        x = 1.0
    weight, drawn = weights(x), set()
    for source, size in tokens.items():
        own = [d for d in docs if d[1] == source]
        quota = math.floor(min(weight[source] * budget * total, size * repeats))
        blocks = -(-len(own) // block)
        parts = defaultdict(list)
        for d in own:
            parts[d[3] % blocks].append(d)
        for epoch in range((quota - 1) // size + 1 if quota else 0):
            at = epoch * size
            keys = {b: spark_hash(True, source or "", source is None, b) for b in parts}
            for b in sorted(parts, key=lambda b: (spark_hash(keys[b], ("i", epoch), ("i", 0)), b)):
                for doc in sorted(parts[b], key=lambda d: d[3]):
                    at += doc[2]
                    if at <= quota:
                        drawn.add((doc[0], epoch))
    return weight, drawn


def compared(found, rows, **options):
    weight, drawn = mixed(rows, **options)
    got = {}
    for r in found:
        assert got.setdefault(r.source, r.weight) == r.weight
    assert got.keys() == {s for i, s, _ in rows if i in {d for d, _ in drawn}}
    assert all(w == pytest.approx(weight[s], rel=1e-9) for s, w in got.items())
    assert {(r.doc_id, r.epoch) for r in found} == drawn and len(found) == len(drawn)


def test_mixing_of_the_whole_table(spark, sf_dir, table):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in table]
    found = QUERIES["op9_source_mixing"](spark, sf_dir).collect()
    compared(found, rows, budget=1.0, entropy=0.98, repeats=2.0, block=4096)


@pytest.mark.parametrize(
    ("budget", "entropy", "repeats"), [(1.0, 1.0, 2.5), (2.0, 0.5, 3.0), (0.3, 0.9, 1.0), (5.0, 0.9, 2.0)]
)
def test_mixing_in_small_blocks(spark, budget, entropy, repeats):
    rows = [
        (i, ("a", "b", None, "c")[0 if i % 3 else i % 4], "é word " * (1 + i % 7) if i % 11 else None)
        for i in range(600)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3)
    found = mixing.mix_sources(docs, budget, entropy, repeats, block=32).collect()
    compared(found, rows, budget=budget, entropy=entropy, repeats=repeats, block=32)
