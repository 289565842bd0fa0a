"""Connected components of a link table, in rounds over tables in the shared folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

#: Links one task contracts at once.
CONTRACTED = 1 << 19


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (larger, smallest of its part) that join the same nodes as the links (a, b)."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    root = np.arange(len(ids))
    x, y = at[: len(a)], at[len(a) :]
    while len(x):
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        apart = low != high
        x, y, low, high = x[apart], y[apart], low[apart], high[apart]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if np.array_equal(up, root):
                break
            root = up
    inner = root != np.arange(len(ids))
    return ids[inner], ids[root[inner]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[np.ndarray] = [np.zeros((2, 0), np.int64)]

    def done() -> pa.RecordBatch:
        a, b = forest(*np.concatenate(held, axis=1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        held.append(np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]))
        if sum(x.shape[1] for x in held) > CONTRACTED:
            yield done()
            held = [np.zeros((2, 0), np.int64)]
    yield done()


def components(links: DataFrame) -> DataFrame:
    """(id, component_id) for every id in `links` (two long columns): the smallest id reachable.

    Each round points every node to its smallest neighbour, follows the pointers a few steps
    and contracts the links; nodes with no smaller neighbour remain. Links are first
    contracted within each task, so a node with very many links is reduced before any shuffle.
    """
    a, b = links.columns
    pairs = links.select(
        F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b")
    ).where("a <> b")
    left = stored(pairs.mapInArrow(_contract, "a long, b long").distinct(), "links")
    nodes = left.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    result = nodes.select("id", F.col("id").alias("component_id"))
    while not left.isEmpty():
        up = left.groupBy("a").agg(F.min("b").alias("b"))
        for _ in range(2):
            up = stored(up, "pointers")
            step = up.select(F.col("a").alias("b"), F.col("b").alias("c"))
            up = up.join(step, "b", "left").select("a", F.coalesce("c", "b").alias("b"))
        up = stored(up, "pointers")
        one = up.select("a", F.col("b").alias("p"))
        two = up.select(F.col("a").alias("b"), F.col("b").alias("q"))
        moved = (
            left.join(one, "a")
            .join(two, "b", "left")
            .select(F.col("p").alias("x"), F.coalesce("q", "b").alias("y"))
            .where("x <> y")
            .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        )
        left = stored(moved.mapInArrow(_contract, "a long, b long").distinct(), "links")
        target = up.select(F.col("a").alias("component_id"), F.col("b").alias("p"))
        result = result.join(target, "component_id", "left").select(
            "id", F.coalesce("p", "component_id").alias("component_id")
        )
    return stored(result, "components")
