"""Exact top-k by integer inner product, one term at a time.

Vectors are sparse rows of integer weights. A unit of work is a block of queries against a
block of candidates. The candidates' weights form a postings list for each dimension; every
query entry adds its weighted postings into the query's dense array of scores. The k best of
each array are selected by partition, and the blocks' selections are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

QUERIES, CANDIDATES = 512, 4096
SCALE = 1024


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    """The non-zero entries of a block's vectors: ids, row sizes, dimensions, weights."""
    rows = [np.asarray(v, dtype=np.int64) for v in group["weights"]]
    at = [np.flatnonzero(v) for v in rows]
    size = np.array([len(a) for a in at], dtype=np.int64)
    parts = [
        group["id"].to_numpy(np.int64),
        size,
        np.concatenate([*at, np.zeros(0, np.int64)]).astype(np.int64),
        np.concatenate([*(v[a] for v, a in zip(rows, at, strict=True)), np.zeros(0, np.int64)]),
    ]
    head = np.array([len(size), int(size.sum())], dtype=np.int64)
    packed = b"".join(p.tobytes() for p in (head, *parts))
    return pd.DataFrame({"block": group["block"].iloc[:1], "packed": [packed]})


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    x = np.frombuffer(raw, np.int64, 2 * n + 2 * m, 16)
    return x[:n], x[n : 2 * n], x[2 * n : 2 * n + m], x[2 * n + m :]


def best(queries: bytes, candidates: bytes, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query id, candidate ids, scores): the k best candidates of each query, itself left out."""
    q_ids, q_size, q_dim, q_weight = _unpack(queries)
    ids, size, dim, weight = _unpack(candidates)
    # Postings of a dimension: the rows that have it, with their weights.
    order = np.argsort(dim, kind="stable")
    row, weight, dim = np.repeat(np.arange(len(ids)), size)[order], weight[order], dim[order]
    end = np.cumsum(q_size)
    for i, query in enumerate(q_ids.tolist()):
        own = slice(end[i] - q_size[i], end[i])
        scores = np.zeros(len(ids), dtype=np.int64)
        low = np.searchsorted(dim, q_dim[own], side="left").tolist()
        high = np.searchsorted(dim, q_dim[own], side="right").tolist()
        for s, e, w in zip(low, high, q_weight[own].tolist(), strict=True):
            # A row stands at most once in the postings of a dimension.
            scores[row[s:e]] += w * weight[s:e]
        other = np.flatnonzero(ids != query)
        if len(other) > k:
            s = scores[other]
            least = s[np.argpartition(s, len(s) - k)[len(s) - k]]
            other = other[s >= least]
        rank = np.lexsort((ids[other], -scores[other]))[:k]
        yield query, ids[other[rank]], scores[other[rank]]


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, q in zip(*(batch.column(c).to_pylist() for c in ("p", "q")), strict=True):
                found = list(best(p, q, k))
                ids = [np.full(len(v), query) for query, v, _ in found]
                empty = [np.zeros(0, np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([*ids, *empty]).astype(np.int64)),
                        pa.array(np.concatenate([*(v for _, v, _ in found), *empty])),
                        pa.array(np.concatenate([*(s for _, _, s in found), *empty])),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def _blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    n = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "weights"), F.lit(n)).cast("int"))
    return stored(dealt.groupBy("block").applyInPandas(_pack, "block int, packed binary"), name), n


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query row.

    Components become floor(scale * x); the score is the integer inner product, where missing
    dimensions count as zero. Every row is a candidate but for those with the query's id; ties
    go to the smaller id. Vectors that are null or have null or non-finite components, and null
    ids, take no part. An empty vector scores zero. Integers beyond 64 bits saturate when
    scaled and wrap in products. Rows that repeat an id are candidates of their own, and
    repeated queries share one list.
    """
    x = F.col(vector_col).cast("array<double>")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & usable).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long")).alias("weights"),
        is_query.alias("asks"),
    )
    queries, n = _blocks(
        rows.where("asks").select("id", "weights").dropDuplicates(["id"]), QUERIES, "queries"
    )
    candidates, m = _blocks(rows.select("id", "weights"), CANDIDATES, "candidates")
    # Every block of queries meets every block of candidates once.
    spread = candidates.select(
        F.col("packed").alias("q"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block")
    )
    units = spread.join(queries.select("block", F.col("packed").alias("p")), "block")
    found = units.repartition(max(1, min(n * m, 4096))).mapInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
