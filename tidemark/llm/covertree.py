"""All pairs of vectors within a cosine threshold, by dual traversal of cover trees.

On unit vectors a cosine threshold is a distance threshold. A cover tree's nodes are nested:
a node's first child has the node's own centre, the centres of its children are more than
half its radius apart, and each node keeps the real distance to its farthest point. Two
trees are walked together; a pair of nodes is dropped if no point of one can be near enough
to a point of the other, and pairs of small nodes are settled by exact cosines in double
precision.

Equal vectors are one node with a count. A label's vectors are dealt into blocks, each with
its own tree; every two blocks of a label are one unit of work, whatever the label's size.
A unit returns, for each of its vectors, how many it is linked to, and a spanning forest of
the links, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, forest
from tidemark.llm.storage import stored

THRESHOLD = 0.93
#: Vectors of one block, and of a node that is not divided further; pairs compared at once.
BLOCK, LEAF, DIRECT = 2048, 64, 1 << 18
#: Slack of a distance against rounding.
SLACK = 1e-6


class Tree:
    """points: unit vectors in tree order; `order` has their places in the input.

    Node i covers points[start[i]:stop[i]] within radius[i] of its centre, points[start[i]].
    Its children are child[i]:child_end[i].
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(points))
        start, stop, radius, child, child_end = [0], [len(points)], [0.0], [0], [0]
        todo = [0] if len(points) else []
        for i in todo:
            own = order[start[i] : stop[i]]
            away = np.linalg.norm(points[own] - points[own[0]], axis=1)
            radius[i] = float(away.max())
            if len(own) <= leaf or radius[i] <= SLACK:
                continue
            # Centres more than half the radius apart; each point goes to the nearest.
            nearest, group = away, np.zeros(len(own), dtype=np.int64)
            left, n = np.flatnonzero(away > radius[i] / 2), 1
            while len(left):
                far = np.linalg.norm(points[own] - points[own[left[0]]], axis=1)
                closer = far < nearest
                nearest, group = np.where(closer, far, nearest), np.where(closer, n, group)
                left, n = left[far[left] > radius[i] / 2], n + 1
            # Centres stand first in their groups: they alone have distance 0 or come first.
            rank = np.lexsort((np.arange(len(own)), nearest, group))
            order[start[i] : stop[i]] = own[rank]
            sizes = np.bincount(group, minlength=n)
            child[i] = len(start)
            for size in sizes[sizes > 0].tolist():
                begin = stop[-1] if len(start) > child[i] else start[i]
                start.append(begin)
                stop.append(begin + size)
                radius.append(0.0)
                child.append(0)
                child_end.append(0)
            child_end[i] = len(start)
            todo += range(child[i], child_end[i])
        self.order = order
        self.points = points[order]
        self.nodes = np.array([start, stop, child, child_end], dtype=np.int64)
        self.radius = np.array(radius)


def near_pairs(
    left: Tree, right: Tree, threshold: float, direct: int = DIRECT
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j), in tree order, of all pairs with cosine >= threshold, in some portions.

    Every pair comes once; of a tree with itself, only i < j. Two nodes of at most `direct`
    pairs of points are compared at once.
    """
    limit = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + SLACK
    same = left is right
    todo = [(0, 0)] if len(left.points) and len(right.points) else []
    while todo:
        i, j = todo.pop()
        s, e, c, d = left.nodes[:, i].tolist()
        t, f, g, h = right.nodes[:, j].tolist()
        self_pair = same and i == j
        if (e - s) * (f - t) <= direct or not (c < d or g < h):
            hits = left.points[s:e] @ right.points[t:f].T >= threshold
            x, y = np.nonzero(np.triu(hits, 1) if self_pair else hits)
            yield s + x, t + y
            continue
        # All pairs of children at once; a node without children stands for itself.
        one = np.arange(c, d) if c < d else np.array([i])
        two = np.arange(g, h) if g < h else np.array([j])
        u, v = left.nodes[:2, one], right.nodes[:2, two]
        dots = left.points[u[0]] @ right.points[v[0]].T
        away = np.sqrt(np.maximum(2 - 2 * dots, 0))
        near = away <= limit + left.radius[one][:, None] + right.radius[two][None, :]
        if self_pair:
            near = np.triu(near)
        # Nodes of one point each are settled by the same cosines.
        single = (u[1] - u[0] == 1)[:, None] & (v[1] - v[0] == 1)[None, :]
        hits = near & single & (dots >= threshold)
        x, y = np.nonzero(np.triu(hits, 1) if self_pair else hits)
        yield u[0][x], v[0][y]
        x, y = np.nonzero(near & ~single)
        todo += zip(one[x].tolist(), two[y].tolist(), strict=True)


def _trees(group: pd.DataFrame) -> pd.DataFrame:
    x = np.array(group["embedding"].tolist(), dtype=np.float64)
    tree = Tree(x / np.linalg.norm(x, axis=1, keepdims=True))
    facts = group[["id", "copies"]].to_numpy(np.int64)[tree.order]
    parts = (tree.points, facts, tree.nodes, tree.radius)
    return pd.DataFrame(
        {
            "label": group["label"].iloc[:1],
            "width": group["width"].iloc[:1],
            "block": group["block"].iloc[:1],
            "tree": [np.array([a.shape[0] if a.ndim == 1 else a.shape[i] for a in parts for i in (0, -1)], np.int64).tobytes()
                     + b"".join(np.ascontiguousarray(a).tobytes() for a in parts)],
        }
    )


def _load(raw: bytes) -> tuple[Tree, np.ndarray]:
    shape = np.frombuffer(raw, np.int64, 8).tolist()
    at, out = 64, []
    for i, kind in enumerate((np.float64, np.int64, np.int64, np.float64)):
        rows, columns = shape[2 * i : 2 * i + 2]
        n = rows if i == 3 else rows * columns
        x = np.frombuffer(raw, kind, n, at)
        out.append(x if i == 3 else x.reshape(rows, columns))
        at += 8 * n
    tree = Tree.__new__(Tree)
    tree.points, facts, tree.nodes, tree.radius = out
    return tree, facts


def _join(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, q, same in zip(*(batch.column(c).to_pylist() for c in ("p", "q", "same")), strict=True):
                left, one = _load(p)
                right, two = (left, one) if same else _load(q)
                count = [np.zeros(len(one), np.int64), np.zeros(len(two), np.int64)]
                found: list[np.ndarray] = []
                held = 0
                for x, y in near_pairs(left, right, threshold):
                    count[0] += np.bincount(x, two[y, 1], len(one)).astype(np.int64)
                    count[1] += np.bincount(y, one[x, 1], len(two)).astype(np.int64)
                    found.append(np.stack((one[x, 0], two[y, 0])))
                    held += len(x)
                    if held > 1 << 20:
                        found = [np.stack(forest(*np.concatenate(found, axis=1)))]
                        held = found[0].shape[1]
                if same:
                    count = [count[0] + count[1]]
                ids = np.concatenate([one[:, 0], two[:, 0]][: len(count)])
                n = np.concatenate(count)
                full = n > 0
                a, b = forest(*np.concatenate(found, axis=1)) if found else (ids[:0], ids[:0])
                none = np.zeros(len(a), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((ids[full], a))),
                        pa.array(np.concatenate((n[full], none))),
                        pa.array(
                            np.concatenate((none[:0], np.zeros(int(full.sum()), np.int64), b)),
                            mask=np.concatenate((np.ones(int(full.sum()), bool), none > 0)),
                        ),
                    ],
                    names=["id", "n", "linked"],
                )

    return run


def link_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
) -> DataFrame:
    """The columns of `vectors` with n_links, component_id and kept.

    Two vectors of one label are linked if their cosine in double precision is at least
    `threshold` (between 0 and 1). n_links: other vectors linked to it; component_id: the
    smallest id reachable; kept: whether that is its own. A null label or id, and a vector
    that is null, empty, zero, or has null or non-finite components, has no link, nor have
    vectors of unequal lengths. Rows that repeat an id count as vectors of their own and share
    the component. Columns of these names in `vectors` are replaced.
    """
    made = ("n_links", "component_id", "kept")
    kept = [c for c in vectors.columns if c.lower() not in made]
    x = F.col(vector_col).cast("array<double>")
    # Scaled by the largest component: no length overflows or vanishes.
    largest = F.array_max(F.transform(x, F.abs))
    usable = (
        F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(x) > 0)
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & (largest > 0)
    )
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.when(usable, F.transform(x, lambda v: v / largest)).alias("embedding"),
    )
    usable_rows = rows.where("embedding is not null")
    classes = stored(
        usable_rows.groupBy("label", "embedding")
        .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("width", F.size("embedding")),
        "classes",
    )
    # Rows that repeat an id may head several classes; places name the classes instead.
    sizes = classes.groupBy("label", "width").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    named = classes.withColumn("class", F.xxhash64("label", "embedding"))
    dealt = named.join(sizes, ["label", "width"]).withColumn(
        "block", F.pmod(F.xxhash64("class", F.lit(5)), F.col("blocks"))
    )
    trees = stored(
        dealt.select("label", "width", "block", F.col("class").alias("id"), "copies", "embedding")
        .groupBy("label", "width", "block")
        .applyInPandas(_trees, "label string, width int, block long, tree binary"),
        "trees",
    )
    one = trees.join(sizes, ["label", "width"]).select(
        "label", "width", F.col("block").alias("i"),
        F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)).alias("j"),
        F.col("tree").alias("p"),
    )
    two = trees.select("label", "width", F.col("block").alias("j"), F.col("tree").alias("q"))
    units = one.join(two, ["label", "width", "j"]).select(
        "p", "q", (F.col("i") == F.col("j")).alias("same")
    )
    tasks = max(1, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = stored(
        units.repartition(tasks).mapInArrow(_join(threshold), "id long, n long, linked long"),
        "found",
    )
    by_class = found.where("linked is null").groupBy("id").agg(F.sum("n").alias("n"))
    heads = named.select("label", "embedding", F.col("class").alias("id"), F.col("id").alias("head"), "copies")
    names = heads.select("id", "head")
    links = (
        found.where("linked is not null")
        .join(names, "id")
        .join(names.select(F.col("id").alias("linked"), F.col("head").alias("other")), "linked")
        .select("head", "other")
    )
    repeated = usable_rows.join(heads.select("label", "embedding", "head"), ["label", "embedding"])
    copies = repeated.where("id <> head").select("id", "head")
    part = components(links.union(copies))
    facts = heads.join(by_class, "id", "left").select(
        "label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "head"
    )
    others = F.struct(*(F.col(f"`{c}`") for c in kept)).alias("others")
    all_rows = vectors.select(
        others,
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.when(usable, F.transform(x, lambda v: v / largest)).alias("embedding"),
    )
    return (
        all_rows.join(facts, ["label", "embedding"], "left")
        .join(part, "id", "left")
        .select(
            *(F.col(f"others.`{c}`") for c in kept),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", F.col("id")).alias("component_id"),
            F.coalesce(F.coalesce("component_id", F.col("id")) == F.col("id"), F.lit(True)).alias("kept"),
        )
    )
