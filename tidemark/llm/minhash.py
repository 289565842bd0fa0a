"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation.

Every document's set of five-word shingles gives `SAMPLES` MinHash values. Groups of them
are band keys; all of them, folded into a bitmap by flipping one bit each, are the odd
sketch. Two sketches differ in few bits exactly when few samples differ, so the population
count of their XOR estimates a high similarity well enough to drop almost every accidental
band partner before the full sets are compared.

Documents with equal sets are one class. In every band bucket the members are compared with
the smallest one first. Only buckets whose members are then still in several components are
compared in blocks, across components, by their sketches. A bucket therefore never expands
into all its pairs, and no link that could join two components is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.storage import free_name, stored
from tidemark.llm.textbatch import mix, slices, words

SAMPLES, ROWS, BITS = 128, 4, 512
WORDS = 5
#: Estimated similarity below the wanted one by this much still goes to the exact check:
#: about six standard deviations of the estimate.
MARGIN = 0.25
#: Members of one block of a bucket.
BLOCK = 2048
_RNG = np.random.default_rng(77)
_FACTOR = _RNG.integers(0, 1 << 32, size=SAMPLES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFT = _RNG.integers(0, 1 << 32, size=SAMPLES, dtype=np.uint64).astype(np.uint32)
_SALT = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64))


def shingle_sets(column: pa.Array, width: int = WORDS) -> Iterator[np.ndarray]:
    """For each text, the sorted 64-bit hashes of its distinct shingles.

    A shingle is `width` consecutive words, A-Z lowered; a shorter text is one shingle.
    """
    w = words(column)
    h = w.hashes(lower=True)
    n = len(h)
    joined = np.zeros(n, dtype=np.uint64)
    for k in range(min(width, n)):
        joined[: n - k] = joined[: n - k] * np.uint64(0xD6E8FEB86659FD93) + h[k:]
    joined = mix(joined)
    for s, e in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if e - s >= width:
            yield np.unique(joined[s : e - width + 1])
        elif e > s:
            short = np.array([e - s], dtype=np.uint64)
            for i in range(s, e):
                short = mix(short * np.uint64(31) + h[i : i + 1])
            yield short
        else:
            yield np.zeros(0, dtype=np.uint64)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each of `SAMPLES` hash functions over a set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(x), 256):
        np.minimum(out, (x[i : i + 256, None] * _FACTOR + _SHIFT).min(axis=0), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    parts = samples.reshape(-1, SAMPLES // ROWS, ROWS).astype(np.uint64)
    key = np.broadcast_to(_SALT[: SAMPLES // ROWS], parts.shape[:2])
    for r in range(ROWS):
        key = mix(key + parts[:, :, r])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps: sample i flips one of `BITS` bits, chosen by i and its value."""
    bit = (mix(samples.astype(np.uint64) + _SALT) >> np.uint64(40)) % np.uint64(BITS)
    rows = np.arange(len(samples), dtype=np.int64)[:, None] * BITS
    flips = np.bincount((rows + bit.astype(np.int64)).ravel(), minlength=len(samples) * BITS)
    odd = (flips & 1).astype(np.uint8).reshape(len(samples), BITS)
    return np.packbits(odd, axis=1).view(np.int64)


def flips_allowed(similarity: float, margin: float = MARGIN) -> int:
    """Most differing bits expected at the lowest similarity that is still confirmed."""
    differing = SAMPLES * (1 - max(0.0, similarity - margin))
    return int(np.ceil(BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * differing))))


_SKETCH = [f"s{i}" for i in range(BITS // 64)]
_SKETCHED = (
    "row_key long, doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, "
    + ", ".join(f"{c} long" for c in _SKETCH)
)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        sizes, first, second, samples = [], [], [], []
        for s in shingle_sets(part.column("text")):
            sizes.append(len(s))
            first.append(mix(s).sum(dtype=np.uint64))
            second.append(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
            samples.append(minhash(s))
        held = np.array(samples, dtype=np.uint32).reshape(len(samples), SAMPLES)
        full = np.array(sizes) > 0
        keys = band_keys(held)
        lists = pa.ListArray.from_arrays(
            np.concatenate(([0], np.cumsum(full * keys.shape[1]))).astype(np.int32),
            pa.array(keys[full].ravel()),
        )
        sketch = odd_sketches(held)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("row_key"),
                part.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(np.array(first, dtype=np.uint64).view(np.int64)),
                pa.array(np.array(second, dtype=np.uint64).view(np.int64)),
                lists,
                *(pa.array(sketch[:, i]) for i in range(sketch.shape[1])),
            ],
            names=["row_key", "doc_id", "n_shingles", "set_a", "set_b", "bands", *_SKETCH],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text"):
        packed = [s.tobytes() for s in shingle_sets(part.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(packed, pa.binary())], names=["id", "shingles"]
        )


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p = np.frombuffer(x.as_buffer(), np.uint64)
                q = np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate((p, q)), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                kept.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return both.mapInArrow(_confirm(percent), "a long, b long")


def _similar(one: np.ndarray, others: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sorted sets are similar enough to the sorted set `one`."""
    sizes = np.array([len(x) for x in others])
    joined = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, joined), len(one) - 1)
    ends = np.cumsum(sizes)
    total = np.concatenate(([0], np.cumsum(one[at] == joined)))
    common = total[ends] - total[ends - sizes]
    return 100 * common >= percent * (len(one) + sizes - common)


def _across(allowed: int, percent: int):
    """Links of one block pair between components, confirmed on full sets; a spanning forest.

    Only pairs that their sketches do not rule out are compared, each in the first band that
    both have, and none between parts that are already joined.
    """

    def run(members: pd.DataFrame) -> pd.DataFrame:
        i, j = members["i"].iloc[0], members["j"].iloc[0]
        left = members[members["block"] == i]
        right = members[members["block"] == j]
        p, q = left[_SKETCH].to_numpy().view(np.uint64), right[_SKETCH].to_numpy().view(np.uint64)
        u, v = left["id"].to_numpy(), right["id"].to_numpy()
        nu, nv = left["n_shingles"].to_numpy(), right["n_shingles"].to_numpy()
        bands_u, bands_v = np.stack(left["bands"].tolist()), np.stack(right["bands"].tolist())
        here = bands_u[0] == members["band"].iloc[0]
        here = int(np.flatnonzero(here)[0])
        sets_u, sets_v = ([np.frombuffer(x, np.uint64) for x in side["shingles"]] for side in (left, right))
        part, code = np.unique(np.concatenate((left["component_id"], right["component_id"])), return_inverse=True)
        root = np.arange(len(part))
        cu, cv = code[: len(u)], code[len(u) :]
        found = []
        for k in range(len(u)):
            bits = np.bitwise_count(q ^ p[k]).sum(axis=1)
            near = (bits <= allowed) & (root[cv] != root[cu[k]])
            near &= 100 * np.minimum(nv, nu[k]) >= percent * np.maximum(nv, nu[k])
            if i == j:
                near &= v > u[k]
            y = np.flatnonzero(near)
            y = y[(bands_v[y, :here] != bands_u[k, :here]).all(axis=1)]
            y = y[np.argsort(bits[y], kind="stable")]
            # Nearest first; a part is done with its first link.
            while len(y):
                some, y = y[:64], y[64:]
                for w in some[_similar(sets_u[k], [sets_v[x] for x in some], percent)].tolist():
                    one, two = root[cu[k]], root[cv[w]]
                    if one != two:
                        root[root == max(one, two)] = min(one, two)
                        found.append((max(u[k], v[w]), min(u[k], v[w])))
                y = y[root[cv[y]] != root[cu[k]]]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
) -> DataFrame:
    """The columns of `docs` with n_shingles, component_id and kept.

    Documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the smallest id reachable by links, kept tells whether it is the own id.
    A null or empty text has no shingles and no link. A null id takes no part: its
    component_id is null and it is kept. Rows that repeat an id are one node: their links
    count together, and each gets a row. Columns of these names in `docs` are replaced.
    """
    # A row's own content keys its measures; equal rows get equal measures.
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(
        key, F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    )
    sketched = stored(
        keyed.select(
            F.col(key).alias("row_key"),
            F.col(id_col).cast("long").alias("doc_id"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).mapInArrow(_sketch, _SKETCHED),
        "sketches",
    )
    found = components(_links(docs, sketched, id_col, text_col, percent))
    marks = sketched.select("row_key", "doc_id", "n_shingles").distinct()
    marks = (
        marks.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
        .select(F.col("row_key").alias(key), "n_shingles", "component_id", "kept")
    )
    old = [c for c in docs.columns if c.lower() in ("n_shingles", "component_id", "kept")]
    return keyed.drop(*old).join(marks, key).drop(key)


def _links(
    docs: DataFrame, sketched: DataFrame, id_col: str, text_col: str, percent: int
) -> DataFrame:
    allowed = flips_allowed(percent / 100)
    usable = sketched.where("doc_id is not null and n_shingles > 0")
    key = ["set_a", "set_b", "n_shingles"]
    # A document may stand for its class only with its own text: its row key goes along.
    classes = stored(
        usable.groupBy(*key).agg(
            F.min(F.struct("doc_id", "row_key")).alias("head"),
            F.first("bands").alias("bands"),
            *(F.first(c).alias(c) for c in _SKETCH),
        ).select("head.doc_id", "head.row_key", *key, "bands", *_SKETCH),
        "classes",
    ).withColumnRenamed("row_key", "id")
    copies = usable.join(
        classes.select(*key, F.col("doc_id").alias("head"), F.col("id").alias("class")), key
    )
    in_class = copies.where("doc_id <> head").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    # Classes are nodes of their own below; their row keys name them.
    members = classes.select(F.explode("bands").alias("band"), "id")
    heads = stored(
        members.groupBy("band")
        .agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("size"))
        .where("size > 1"),
        "buckets",
    )
    members = stored(members.join(heads, "band"), "members")
    wanted = members.select("id").distinct()
    texts = docs.select(
        F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    sets = stored(
        texts.join(wanted, "id", "left_semi").mapInArrow(_sets, "id long, shingles binary")
        .dropDuplicates(["id"]),
        "sets",
    )
    star = (
        members.where("id <> head")
        .select(F.greatest("id", "head").alias("a"), F.least("id", "head").alias("b"))
        .distinct()
    )
    sketch = classes.select("id", "n_shingles", *_SKETCH)
    one = sketch.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), *_SKETCH)
    two = sketch.select(
        F.col("id").alias("b"), F.col("n_shingles").alias("nb"),
        *(F.col(c).alias(f"t{c}") for c in _SKETCH),
    )
    differ = sum(
        (F.bit_count(F.col(c).bitwiseXOR(F.col(f"t{c}"))) for c in _SKETCH), F.lit(0)
    )
    near = (
        star.join(one, "a").join(two, "b")
        .where(differ <= allowed)
        .where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
        .select("a", "b")
    )
    first = stored(_confirmed(near, sets, percent), "confirmed")
    part = components(first)
    # A bucket of two is settled by its one pair.
    open_members = (
        members.where("size > 2")
        .join(part, "id", "left")
        .withColumn("component_id", F.coalesce("component_id", "id"))
    )
    unsettled = stored(
        open_members.groupBy("band")
        .agg(F.min("component_id").alias("low"), F.max("component_id").alias("high"))
        .where("low <> high")
        .select("band"),
        "unsettled",
    )
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    spread = (
        stored(open_members.select("band", "size", "id", "component_id"), "open")
        .join(unsettled, "band")
        .join(classes.select("id", "n_shingles", "bands", *_SKETCH), "id")
        .join(sets, "id")
        .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
    )
    second = stored(
        spread.groupBy("band", "i", "j").applyInPandas(
            _across(allowed, percent), "a long, b long"
        ),
        "confirmed",
    )
    names = classes.select("id", "doc_id")
    linked = (
        first.union(second)
        .join(names.select(F.col("id").alias("a"), F.col("doc_id").alias("p")), "a")
        .join(names.select(F.col("id").alias("b"), F.col("doc_id").alias("q")), "b")
        .select(F.col("p").alias("a"), F.col("q").alias("b"))
    )
    return in_class.union(linked)
