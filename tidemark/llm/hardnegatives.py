"""Hard negatives by exact integer inner products, several candidates in each multiplication.

Components are integers. A bias makes them non-negative, and the biased components of several
candidates stand in separate fields of one wide integer, so one multiplication by an anchor's
biased component serves all of them (Kronecker substitution). A field is wide enough for the
largest sum of products, so no field carries into the next; the scores are unpacked and the
biases taken off again.

Rows are dealt into blocks of candidates that are written once: a label with more rows than a
block is split, smaller labels share blocks. Positives come from the blocks that hold the
anchor's label, negatives from all blocks. Only packed blocks of anchors, the small side, are
copied to the blocks of candidates, and a task meets them one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

SCALE = 256
#: Rows of a block of anchors, and the least and most of a block of candidates.
ANCHORS, LEAST, MOST = 512, 1024, 32768
#: Scores that are computed at once.
CELLS = 1 << 18
#: Field widths beyond half a machine word use Python's integers, with so many fields.
FIELDS = 16
_LARGEST = (1 << 63) - 1


def _fields(bits: int) -> tuple[int, int, type]:
    """(fields, bits of each, kind) of a wide integer with fields of at least `bits`."""
    if 2 * bits <= 64:
        return 64 // bits, 64 // (64 // bits), np.uint64
    return FIELDS, bits, int


def _exact(x: np.ndarray, big: bool) -> np.ndarray:
    return x.astype(object) if big else x


class Packed:
    """Candidates packed for anchors whose components lie between `low` and `high`."""

    def __init__(self, candidates: np.ndarray, low: int, high: int) -> None:
        m, d = candidates.shape
        self.m, self.d, self.low = m, d, low
        self.low_c, top = int(candidates.min(initial=0)), int(candidates.max(initial=0))
        bits = max(1, (d * (high - low) * (top - self.low_c)).bit_length())
        count, self.bits, self.wide = _fields(bits)
        # Sums that machine words cannot hold are left to Python's integers.
        most = max(abs(low), abs(high), 1) * max(abs(self.low_c), abs(top), 1)
        self.big = 4 * d * most >= _LARGEST or self.wide is int
        kind = object if self.wide is int else np.uint64
        # Candidate j * words + w stands in field j of word w.
        words = -(-m // count)
        biased = np.zeros((count * words, d), dtype=kind)
        biased[:m] = (_exact(candidates, self.big) - self.low_c).astype(kind)
        self.shifts = [self.wide(self.bits * j) for j in range(count)]
        self.packed = np.zeros((d, words), dtype=kind)
        for j in range(count):
            field = biased[j * words : (j + 1) * words].T
            self.packed = self.packed + field * self.wide(1 << self.bits * j)
        self.sums = _exact(candidates, self.big).sum(axis=1)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products with every candidate, clamped at 2^63 - 1 either way."""
        if not self.m or not self.d:
            return np.zeros((len(anchors), self.m), dtype=np.int64)
        held = _exact(anchors, self.big)
        biased = (held - self.low).astype(self.packed.dtype)
        total = biased[:, :1] * self.packed[0]
        for k in range(1, self.d):
            total += biased[:, k, None] * self.packed[k]
        mask = self.wide((1 << self.bits) - 1)
        fields = np.concatenate([(total >> s) & mask for s in self.shifts], axis=1)[:, : self.m]
        # The sum of (x - p) (y - q) is that of x y, less q x and p y, with d p q added.
        kind = object if self.big else np.int64
        out = fields.astype(kind) + self.low_c * held.sum(axis=1)[:, None]
        out = out + self.low * self.sums - self.d * self.low * self.low_c
        if self.big:
            out = np.clip(out, -_LARGEST, _LARGEST)
        return out.astype(np.int64)


def tables(anchors: np.ndarray, candidates: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first anchor, scores) of slices of anchors. Missing dimensions add nothing."""
    d = min(anchors.shape[1], candidates.shape[1])
    anchors, candidates = anchors[:, :d], candidates[:, :d]
    packed = Packed(candidates, int(anchors.min(initial=0)), int(anchors.max(initial=0)))
    step = max(1, CELLS // max(1, len(candidates)))
    for i in range(0, len(anchors), step):
        yield i, packed.scores(anchors[i : i + step])


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    """A block's rows as bytes: counts, ids, labels, and components padded with zeros."""
    rows = [np.asarray(v, dtype=np.int64) for v in group["weights"]]
    matrix = np.zeros((len(rows), max(map(len, rows))), dtype=np.int64)
    for i, v in enumerate(rows):
        matrix[i, : len(v)] = v
    least = np.min_scalar_type(int(max(abs(int(matrix.min(initial=0))), int(matrix.max(initial=0)))))
    narrow = {1: np.int16, 2: np.int32, 4: np.int64}.get(least.itemsize, np.int64)
    head = np.array([*matrix.shape, np.dtype(narrow).itemsize], dtype=np.int64)
    parts = [head, group["id"].to_numpy(np.int64), group["label"].to_numpy(np.int64)]
    packed = b"".join(p.tobytes() for p in (*parts, matrix.astype(narrow)))
    return pd.DataFrame({"block": group["block"].iloc[:1], "packed": [packed]})


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, d, wide = np.frombuffer(raw, np.int64, 3).tolist()
    ids, labels = np.frombuffer(raw, np.int64, 2 * n, 24).reshape(2, n)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[wide]
    return ids, labels, np.frombuffer(raw, kind, n * d, 24 + 16 * n).reshape(n, d).astype(np.int64)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by score, then by smaller id."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((ids[at], -score[at]))[:k]]


Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def positives(anchors: Block, candidates: Block, k: int) -> Iterator[tuple]:
    """(anchor, ids, scores): the k best rows of the anchor's label within the block."""
    (a_ids, a_labels, a), (ids, labels, c) = anchors, candidates
    for first, table in tables(a, c):
        for i, row in enumerate(table, first):
            at = np.flatnonzero((labels == a_labels[i]) & (ids != a_ids[i]))
            at = at[_best(row[at], ids[at], k)]
            yield a_ids[i], ids[at], row[at]


def negatives(
    anchors: Block, candidates: Block, wanted: dict[int, list[int]], k: int, percent: int
) -> Iterator[tuple]:
    """(anchor, positive score, ids, scores): the k best rows of other labels within the block
    whose score is at most the positive's and at least `percent` of it."""
    (a_ids, a_labels, a), (ids, labels, c) = anchors, candidates
    for first, table in tables(a, c):
        for i, row in enumerate(table, first):
            tops = wanted.get(int(a_ids[i]), [])
            # The least integer that is at least `percent` of the score.
            low = [-((-percent * top) // 100) for top in tops]
            if not tops or max(tops) < min(low):
                continue
            near = (row <= max(tops)) & (row >= min(low)) & (labels != a_labels[i])
            at = np.flatnonzero(near)
            at = at[np.lexsort((ids[at], -row[at]))]
            rising = row[at][::-1]
            for top, least in zip(tops, low, strict=True):
                start = len(at) - np.searchsorted(rising, top, side="right")
                stop = min(start + k, len(at) - np.searchsorted(rising, least, side="left"))
                if stop > start:
                    yield a_ids[i], top, ids[at[start:stop]], row[at[start:stop]]


def _columns(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    """One row per id of `parts`, whose last two fields are arrays of ids and scores."""
    sizes = [len(p[-1]) for p in parts]
    heads = [np.repeat(np.array([p[j] for p in parts], dtype=np.int64), sizes) for j in range(len(names) - 2)]
    ends = [np.concatenate([np.zeros(0, np.int64), *(p[j] for p in parts)]) for j in (-2, -1)]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (*heads, *ends)], names=names)


_WANTED = "array<struct<id: long, scores: array<long>>>"


def _meet(asked: DataFrame, blocks: DataFrame, visit, names: list[str]) -> DataFrame:
    """Rows that `visit` finds for each block of anchors and the block of candidates it names.

    A task reads a block of candidates and then, one by one, the blocks of anchors sent to it.
    """
    held = blocks.select("block", F.lit(0).alias("turn"), "packed", F.lit(None).cast(_WANTED).alias("wanted"))
    rows = held.unionByName(asked.select("block", F.lit(1).alias("turn"), "packed", "wanted"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, candidates = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["turn"] == 0:
                    number, candidates = row["block"], _unpack(row["packed"])
                elif row["block"] == number:
                    tops = {w["id"]: w["scores"] for w in row["wanted"] or ()}
                    yield _columns(list(visit(_unpack(row["packed"]), candidates, tops)), names)

    placed = rows.repartition(tasks, "block").sortWithinPartitions("block", "turn")
    return placed.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _pack_anchors(group: pd.DataFrame) -> pd.DataFrame:
    return _pack(group).assign(home=group["home"].iloc[0])


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    n_positives: int = 5,
    n_negatives: int = 5,
    percent: int = 80,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    most: int = MOST,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(scale * x), a score is the integer inner product of two rows, and
    missing dimensions count as zero. An anchor's positives are its best rows of the same label;
    for each, the best rows of other labels follow whose score is at most the positive's and at
    least `percent` of it. Ties go to the smaller id; all are returned if there are fewer.
    Rows whose id, label or vector is null, or that have a null or non-finite component, take no
    part. A row is never compared with its own id; rows that repeat an id are candidates of
    their own, and of repeated anchors the one with the smallest label and vector asks. An empty
    vector scores zero. Scaled components saturate at 64 bits, and scores at 2^63 - 1 either way.
    """
    label = F.col("label") if label is None else label
    x = F.col(vector_col).cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = stored(
        vectors.select(
            F.col(id_col).cast("long").alias("id"),
            label.cast("long").alias("label"),
            F.when(usable, F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))).alias("weights"),
            F.coalesce(is_anchor, F.lit(False)).alias("asks"),
        ).where("id is not null and label is not null and weights is not null"),
        "rows",
    )
    spark, total = rows.sparkSession, rows.count()
    slots = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = min(most, max(min(LEAST, most), -(-total // slots)))
    shared = max(1, -(-total // size))
    # Blocks 0 to shared - 1 hold the labels that fit into one; those of others are below zero.
    parts = rows.groupBy("label").agg(F.ceil(F.count("*") / F.lit(size)).cast("long").alias("parts"))
    parts = stored(parts.where("parts > 1"), "labels")

    def block(part: Column) -> Column:
        own = F.xxhash64("label", part).bitwiseOR(F.lit(-(1 << 63)))
        return F.when(F.col("parts").isNull(), F.pmod(F.xxhash64("label"), F.lit(shared))).otherwise(own)

    part = F.pmod(F.xxhash64("id", "weights"), F.col("parts"))
    dealt = rows.join(parts, "label", "left").withColumn("block", block(part))
    blocks = stored(
        dealt.groupBy("block").applyInPandas(_pack, "block long, packed binary"), "candidates"
    )

    first = F.min(F.struct("label", "weights")).alias("row")
    anchors = stored(
        rows.where("asks").groupBy("id").agg(first).select("id", "row.label", "row.weights"), "anchors"
    )
    n = max(1, -(-anchors.count() // ANCHORS))

    def group(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(n))

    # Positives: an anchor goes to the blocks that hold its label. Those that share a block of
    # small labels are no more than its rows; those of a split label go in groups.
    homes = anchors.join(parts, "label", "left").select(
        "id", "label", "weights", "parts",
        F.when(F.col("parts").isNull(), F.lit(0)).otherwise(group("id")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"),
    ).withColumn("home", block(F.col("part")))
    packed = homes.groupBy("home", "block").applyInPandas(
        _pack_anchors, "block long, packed binary, home long"
    )
    found = _meet(
        packed.select(F.col("home").alias("block"), "packed", F.lit(None).cast(_WANTED).alias("wanted")),
        blocks,
        lambda a, c, tops: positives(a, c, n_positives),
        ["anchor_id", "vec_id", "score"],
    )
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_positives)
    near = stored(found, "positives")

    # Negatives: every block of anchors meets every block of candidates once, by number.
    tops = near.groupBy("anchor_id").agg(F.collect_set("score").alias("scores"))
    tops = tops.groupBy(group("anchor_id").alias("block")).agg(
        F.collect_list(F.struct(F.col("anchor_id").alias("id"), "scores")).alias("wanted")
    )
    packed = anchors.withColumn("block", group("id")).groupBy("block").applyInPandas(
        _pack, "block long, packed binary"
    )
    asked = stored(packed.join(tops, "block"), "asked")
    numbers = blocks.select(
        F.col("block").alias("home"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block")
    )
    spread = numbers.join(asked, "block").select(F.col("home").alias("block"), "packed", "wanted")
    other = _meet(
        spread, blocks,
        lambda a, c, tops: negatives(a, c, tops, n_negatives, percent),
        ["anchor_id", "positive_score", "vec_id", "score"],
    )
    each = Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("score"), "vec_id")
    hard = other.withColumn("rank", F.row_number().over(each)).where(F.col("rank") <= n_negatives)
    pairs = near.select(
        "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return pairs.join(hard, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
