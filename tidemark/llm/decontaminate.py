"""Benchmark decontamination with DataFrame functions only.

The windows of the benchmark's items, `WIDTH` normalised words each, form a table of distinct
n-grams that every task holds as a hash set. Each document's word positions are exploded with
the hash of the window that starts there and meet that set in the same stage; a hit counts
only if the words themselves are equal. A table beyond `SENT` bytes is dealt into blocks of
that size, and the documents are scanned once for each block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import free_name, stored

WIDTH = 10
#: Bytes of n-grams and item ids that are sent to every task at once.
SENT = 64 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII characters outside words, once A-Z are lower-cased.
_OUTSIDE = "".join(map(chr, [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_PARTS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FIRST = r"^[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Key of the row that every document has beside its windows.
_OWN = 0


def normal_words(text: Column) -> Column:
    """Words of a text: A-Z in lower case, cut at ASCII characters other than 0-9 and a-z."""
    plain = F.translate(
        F.coalesce(text, F.lit("")), _UPPER + _OUTSIDE, _UPPER.lower() + " " * len(_OUTSIDE)
    )
    return F.array_remove(F.split(plain, " "), "")


def _grams(benchmark: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(key, gram, items): the distinct windows of all items and the ids of their items."""
    items = benchmark.select(
        F.col(f"`{id_col}`").cast("string").alias("item"),
        normal_words(F.col(f"`{text_col}`").cast("string")).alias("words"),
    ).where(F.size("words") > 0)
    last = F.greatest(F.size("words") - width, F.lit(0))
    windows = items.select(
        "item", "words", F.explode(F.sequence(F.lit(0), last)).alias("at")
    ).select("item", F.slice("words", F.col("at") + 1, F.lit(width)).alias("gram"))
    return (
        windows.groupBy("gram")
        .agg(F.collect_set("item").alias("items"))
        .select(F.xxhash64("gram").alias("key"), "gram", "items")
    )


def _positions(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """One row per document, with key `_OWN`, and one for each window that starts in it."""
    # The place behind the last word stands for the document itself.
    places = F.posexplode(F.concat("words", F.array(F.lit("")))).alias("at", "first")
    placed = docs.select("doc", "row_key", "words", places).drop("first")
    n = F.size("words")
    keys = [
        F.when(F.col("at") + m <= n, F.xxhash64(F.slice("words", F.col("at") + 1, F.lit(m))))
        for m in lengths
    ]
    keys[0] = F.when(F.col("at") == n, F.lit(_OWN).cast("long")).otherwise(keys[0])
    key = keys[0] if len(keys) == 1 else F.explode(F.array(*keys))
    return placed.withColumn("key", key).where("key is not null")


def _hits(docs: DataFrame, benchmark: DataFrame, width: int, item_col: str, item_text: str, sent: int) -> DataFrame:
    """(doc, row_key, n_words, copies, hits, items) per document; `docs` has doc, row_key, words.

    `hits` holds (at, length) of the windows found, `items` the sets of their items.
    """
    grams = stored(_grams(benchmark, width, item_col, item_text), "grams")
    size = F.sum(F.length(F.array_join("gram", " ")) + F.length(F.array_join("items", " ")) + 64)
    bytes_, lengths = grams.agg(size, F.collect_set(F.size("gram"))).first()
    lengths = sorted(lengths) or [width]
    blocks = -(-max(bytes_ or 0, 1) // sent)
    own = docs.sparkSession.range(1).select(
        F.lit(_OWN).cast("long").alias("key"),
        F.array().cast("array<string>").alias("gram"),
        F.array().cast("array<string>").alias("items"),
    )
    places, met = _positions(docs, lengths), None
    for b in range(blocks):
        part = grams.where(F.pmod("key", F.lit(blocks)) == b)
        part = part.unionByName(own) if b == 0 else part
        same = F.slice("words", F.col("at") + 1, F.size("gram")) == F.col("gram")
        found = places.join(F.broadcast(part), "key").where(same).select(
            "doc", "row_key", F.size("words").alias("n"), "at", F.size("gram").alias("length"), "items"
        )
        met = found if met is None else met.unionByName(found)
    hit = F.col("length") > 0
    return met.groupBy("doc", "row_key").agg(
        F.max("n").alias("n_words"),
        F.count(F.when(~hit, 1)).alias("copies"),
        F.array_sort(F.collect_set(F.when(hit, F.struct("at", "length")))).alias("hits"),
        F.array_sort(
            F.array_distinct(F.flatten(F.collect_set(F.when(hit, F.col("items")))))
        ).alias("items"),
    )


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("row_key"),
        normal_words(text).alias("words"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    sent: int = SENT,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans.

    A window is `width` consecutive words of an item; an item with fewer words, but not none, is
    one window. A document's word inside any occurrence of a window is hit; `spans` lists the
    merged word ranges (start, stop). items_sha256 is over the ids of the items with occurring
    windows, sorted as strings and joined by commas. Null and empty texts have no words, and an
    item without words has no window. Windows of items without an id hit words but name no item.
    Rows that repeat an id are judged each on its own, so equal rows give equal results; an empty
    benchmark leaves all documents clean.
    """
    found = _hits(_keyed(docs, id_col, text_col), benchmark, width, item_col, item_text, sent)
    stop = lambda h: h["at"] + h["length"]
    n_hit = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("stop"), F.lit(0).cast("long").alias("n")),
        lambda a, h: F.struct(
            F.greatest(a["stop"], stop(h)).alias("stop"),
            (a["n"] + F.greatest(F.lit(0), stop(h) - F.greatest(a["stop"], h["at"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    judged = found.select(
        F.col("doc").alias("doc_id"),
        "row_key",
        F.col("n_words").cast("long").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        _runs(F.col("hits")).alias("spans"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    )
    return judged.drop("copy")


def _runs(hits: Column) -> Column:
    """Merged ranges (start, stop) of the words that `hits` cover."""
    words = F.array_sort(
        F.array_distinct(
            F.flatten(F.transform(hits, lambda h: F.sequence(h["at"], h["at"] + h["length"] - 1)))
        )
    )
    edge = lambda step: F.filter(
        words, lambda x, i: ~F.coalesce(F.get(words, i + step) == x + step, F.lit(False))
    )
    return F.zip_with(
        edge(-1), edge(1), lambda a, b: F.named_struct(F.lit("start"), a, F.lit("stop"), b + 1)
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    by: str = "spans",
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    sent: int = SENT,
) -> DataFrame:
    """`docs` without what they share with the benchmark.

    by="spans" cuts each run of hit words, with what stands between them, out of the text;
    by="documents" drops the documents with a hit word. Other columns, whatever their names,
    and rows without a hit (null texts too) stay as they are.
    """
    if by not in ("spans", "documents"):
        raise ValueError(f"by is 'spans' or 'documents', not {by!r}")
    judged = contamination(docs, benchmark, width, id_col, text_col, item_col, item_text, sent)
    hit = judged.where("contaminated").select("doc_id", "row_key", "spans").distinct()
    row, found = free_name(docs, "row"), free_name(docs, "found")
    hit = hit.select(F.struct("doc_id", "row_key", "spans").alias(found))
    text = F.col(f"{row}.`{text_col}`")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(row))
    same = F.col(f"{row}.`{id_col}`").eqNullSafe(F.col(f"{found}.doc_id")) & (
        F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))) == F.col(f"{found}.row_key")
    )
    if by == "documents":
        return packed.join(hit, same, "left_anti").select(f"{row}.*")
    met = packed.join(hit, same, "left")
    clean = F.when(F.col(found).isNull(), text).otherwise(_cut(text, F.col(f"{found}.spans")))
    return met.select(
        *(
            (clean if c == text_col else F.col(f"{row}.`{c}`")).alias(c)
            for c in docs.columns
        )
    )


def _cut(text: Column, spans: Column) -> Column:
    """`text` without the word ranges `spans`. Words and what lies between them alternate."""
    parts = F.regexp_extract_all(text, F.lit(_PARTS), F.lit(0))
    shift = F.when(text.rlike(_FIRST), 0).otherwise(1)
    kept = F.transform(
        F.sequence(F.lit(0), F.size(spans)),
        lambda i: F.slice(
            parts,
            F.coalesce(2 * F.get(spans, i - 1)["stop"] - 1 + shift, F.lit(0)) + 1,
            F.coalesce(2 * F.get(spans, i)["start"] + shift, F.size(parts))
            - F.coalesce(2 * F.get(spans, i - 1)["stop"] - 1 + shift, F.lit(0)),
        ),
    )
    return F.array_join(F.flatten(kept), "")
