"""Mixing sources by temperature, within a budget of tokens.

A source's weight is its share of all tokens to the power of an exponent between 0 (all
alike) and 1 (as they are). The exponent is bisected: flat enough to reach the wanted
entropy, steep enough that no source is repeated too often. A weight is then a quota of
tokens, and a quota is filled by going through the source's blocks in a new order every
epoch: whole blocks, and of the last one the documents that still fit, by hash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored

#: Documents of one block, and sources whose weights are broadcast; the others' are joined.
BLOCK, SOURCES = 4096, 4096
#: The exponent is narrowed down to one of so many parts, so often.
_PARTS, _ROUNDS = 64, 10
#: A type whose sums do not depend on their order.
_EXACT = "decimal(38,24)"

#: For each exponent, the sums over all sources of r and of r ln(share), with r = share ** x.
Curve = Callable[[list[float]], list[tuple[float, float]]]


def exponent(tokens: list[int], budget: float, entropy: float, repeats: float) -> float:
    """The largest exponent in [0, 1] with an entropy of at least `entropy` times the most
    possible one, or the larger one that keeps every source within `repeats` of its tokens.

    Where even exponent 1 repeats too often, it is 1."""
    total = sum(tokens)

    def curve(exponents: list[float]) -> list[tuple[float, float]]:
        raw = [[(t / total) ** x for t in tokens] for x in exponents]
        return [(sum(r), sum(a * math.log(t / total) for a, t in zip(r, tokens, strict=True))) for r in raw]

    return search(curve, len(tokens), total, min(tokens, default=0), budget, entropy, repeats)


def search(
    curve: Curve, sources: int, total: int, least: int, budget: float, entropy: float, repeats: float
) -> float:
    """The exponent for so many sources, of which the smallest has `least` tokens."""
    if sources < 2:
        return 1.0

    def flat(x: float, z: float, s: float) -> bool:
        return math.log(z) - x * s / z >= entropy * math.log(sources) - 1e-12

    def rare(x: float, z: float, s: float) -> bool:
        # Up to exponent 1, no source is repeated more often than the smallest.
        return (least / total) ** x / z * budget <= repeats * least

    def holds(test, x: float) -> bool:
        return test(x, *curve([x])[0])

    def narrow(low: float, high: float, keep_low) -> tuple[float, float]:
        for _ in range(_ROUNDS):
            xs = [low + (high - low) * i / _PARTS for i in range(1, _PARTS)]
            for x, (z, s) in zip(xs, curve(xs), strict=True):
                if not keep_low(x, z, s):
                    high = x
                    break
                low = x
        return low, high

    wanted = 1.0 if holds(flat, 1.0) else narrow(0.0, 1.0, flat)[0]
    if holds(rare, wanted):
        return wanted
    if budget > repeats * total:
        return 1.0
    return narrow(wanted, 1.0, lambda *at: not rare(*at))[1]


def normalised(tokens: list[int], x: float) -> list[float]:
    total = sum(tokens)
    raw = [(t / total) ** x for t in tokens]
    return [r / sum(raw) for r in raw]


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def mix_sources(
    docs: DataFrame,
    budget: float = 1.0,
    entropy: float = 0.98,
    repeats: float = 2.0,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """The columns of `docs` with n_tokens, weight, epoch and place; a row for each use.

    `budget`: tokens to give out, as a multiple of all tokens (words) there are; no source
    gives more than `repeats` times its own. A document appears once in each full epoch of
    its source and at most once in the last, part epoch. Sorting by place (0 to 1) interleaves
    the sources by weight. A null source is one of its own. Documents without words are never drawn. Equal rows are drawn together
    or cut apart by the quota like any others. Columns of these names in `docs` are replaced.
    """
    made = ("n_tokens", "weight", "epoch", "place")
    kept = [c for c in docs.columns if c.lower() not in made]
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(F.col(f"`{text_col}`")).alias("n_tokens"),
        F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), F.lit(seed)).alias("h"),
    ).where("n_tokens > 0")
    sizes = rows.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("d"))
    sizes = stored(sizes, "sources")
    all_ = sizes.agg(
        F.sum("t").alias("t"), F.count(F.lit(1)).alias("n"), F.min("t").alias("least")
    ).first()
    total = all_["t"] or 1
    wanted = budget * total
    share = F.col("t") / F.lit(total)
    by_total = stored(sizes.groupBy("t").agg(F.count(F.lit(1)).alias("n")), "totals")

    def curve(exponents: list[float]) -> list[tuple[float, float]]:
        tried = F.explode(F.array(*(F.lit(i) for i in range(len(exponents)))))
        x = F.element_at(F.array(*(F.lit(float(x)) for x in exponents)), F.col("i") + 1)
        r = F.pow(share, x) * F.col("n")
        sums = (
            by_total.withColumn("i", tried)
            .groupBy("i")
            .agg(F.sum(r.cast(_EXACT)).alias("z"), F.sum((r * F.ln(share)).cast(_EXACT)).alias("s"))
            .collect()
        )
        return [(float(c["z"]), float(c["s"])) for c in sorted(sums)]

    x = search(curve, all_["n"], total, all_["least"], wanted, entropy, repeats)
    z = curve([x])[0][0] if all_["n"] else 1.0
    weight = F.pow(share, F.lit(x)) / F.lit(z)
    plan = stored(
        sizes.select(
            F.col("source").alias("name"),
            weight.alias("weight"),
            F.floor(F.least(weight * wanted, F.col("t") * F.lit(float(repeats)))).cast("long").alias("quota"),
            F.col("t").alias("total"),
            F.ceil(F.col("d") / block).cast("long").alias("blocks"),
        ),
        "weights",
    )
    same = F.col("source").eqNullSafe(F.col("name"))
    if all_["n"] <= SOURCES:
        dealt = rows.join(F.broadcast(plan), same)
    else:
        # Sources with the most documents would be hot keys; no other has more than 1/SOURCES.
        large = stored(plan.orderBy(F.desc("blocks"), F.desc("total"), "name").limit(SOURCES), "large")
        small = plan.join(F.broadcast(large.select(F.col("name").alias("source"))), same, "left_anti")
        few = F.broadcast(large.select("name"))
        dealt = rows.join(F.broadcast(large), same).unionByName(
            rows.join(few, same, "left_anti").join(small, same)
        )
    dealt = dealt.drop("source").withColumn("block", F.pmod(F.col("h"), F.col("blocks")))
    key = F.xxhash64(F.lit(True), F.coalesce("name", F.lit("")), F.col("name").isNull(), "block")
    dealt = dealt.withColumn("block_key", key)
    totals = stored(
        dealt.groupBy("name", "block", "block_key", "weight", "quota", "total")
        .agg(F.sum("n_tokens").alias("size")),
        "blocks",
    )
    # An epoch is the whole source; blocks come in an order of its own in each.
    epochs = totals.withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.floor((F.col("quota") - 1) / F.col("total")).cast("int")))
    ).where("quota > 0")
    by_order = (
        Window.partitionBy("name", "epoch")
        .orderBy(F.xxhash64("block_key", "epoch", F.lit(seed)), "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    begun = epochs.withColumn(
        "base", F.col("epoch") * F.col("total") + F.coalesce(F.sum("size").over(by_order), F.lit(0))
    ).where(F.col("base") < F.col("quota"))
    chosen = stored(begun.select("block_key", "epoch", "base", "size"), "chosen")
    inner = Window.partitionBy("block_key", "epoch").orderBy("h").rowsBetween(
        Window.unboundedPreceding, 0
    )
    drawn = dealt.join(chosen, "block_key").withColumn("at", F.col("base") + F.sum("n_tokens").over(inner))
    return drawn.where("at <= quota").select(
        *(F.col(f"row.`{c}`") for c in kept),
        "n_tokens",
        "weight",
        "epoch",
        ((F.col("at") - F.col("n_tokens")) / F.col("quota")).alias("place"),
    )
