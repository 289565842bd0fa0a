"""Collocations: phrases of two to five words that occur together more often than their parts.

Texts are parsed into overlapping chunks: where the hash of `WORDS - 1` consecutive words is
0 modulo `MARK`, a chunk ends with those words and the next one begins with them. The cut
depends on the words alone, so equal passages give equal chunks wherever they stand, and the
parse becomes a dictionary of distinct chunks with frequencies. Phrases are counted in the
distinct chunks only, weighted; one that lies in an overlap belongs to the later chunk, as a
chunk owns the words before its closing trigger.

Counting goes word by word: a phrase can be frequent only if the two phrases one word shorter
are. The frequent ones of a length set bits in a table of `BITS` bits, which every task of the
next pass holds. A bit set by another phrase lets some rare phrases through, which their exact
counts then drop, so the table bounds memory and never decides a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.superkmers import run_hashes
from tidemark.llm.textbatch import mix, ragged, range_hashes, slices, text_bytes, words

WORDS, LEAST, FIRST = 5, 100, 2000
#: One in so many places begins a chunk.
MARK = 32
#: Bits of the table of frequent phrases that goes to every task, a power of two.
BITS = 1 << 26
#: Bytes of chunks whose phrases are counted together before they are sent.
SLICE = 8 << 20
_BITMAP = 32768

#: What ends a word, and what also ends a piece of text.
BLANK = np.zeros(256, dtype=bool)
BLANK[[32, 9]] = True
STOP = np.zeros(256, dtype=bool)
STOP[[ord(c) for c in ".,;:!?"]] = True
STOP[10:14] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The byte ranges of `data` as strings. Ranges may overlap."""
    ends = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=ends[1:])
    raw = np.ascontiguousarray(data[ragged(starts, sizes)])
    return pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(raw))


def parse(column: pa.Array, width: int, mark: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(text, chunk, last) of the chunks of a batch of texts, in order.

    A chunk is its words, in lower case, with a blank or, between pieces, a line feed between
    them. All but a text's last chunk end with the `width - 1` words that begin the next one.
    """
    data, at = text_bytes(column)
    full = ~(BLANK[data] | STOP[data])
    n = len(data)
    begin, after = np.ones(n + 1, dtype=bool), np.ones(n + 1, dtype=bool)
    begin[1:n] = ~full[: max(n - 1, 0)][: max(n - 1, 0)] if n else True
    begin[at] = True
    starts = np.flatnonzero(full & begin[:n])
    after[: max(n - 1, 0)] = ~full[1:]
    after[at[at > 0] - 1] = True
    ends = np.flatnonzero(full & after[:n]) + 1
    if not len(starts):
        return np.zeros(0, np.int64), pa.array([], pa.string()), np.zeros(0, bool)
    first = np.searchsorted(starts, at)
    text = np.repeat(np.arange(len(at) - 1), np.diff(first))
    data = LOWER[data]
    hashes = range_hashes(data, starts, ends)
    # Each word with one byte behind it: a blank, or a line feed where a piece ends.
    stops = np.cumsum(STOP[data])
    sizes = ends - starts + 1
    tail = np.cumsum(sizes) - 1
    flat = np.append(data, np.uint8(32))[ragged(starts, sizes)]
    flat[tail] = 32
    cut = np.flatnonzero(stops[starts[1:]] != stops[ends[:-1] - 1])
    flat[tail[cut]] = 10
    # Places of chunks: where a text begins, and where its triggers do.
    lap = width - 1
    opens = np.zeros(len(starts), dtype=bool)
    opens[first[:-1][np.diff(first) > 0]] = True
    near = run_hashes(hashes, lap)
    inside = text[: len(near)] == text[lap - 1 : lap - 1 + len(near)]
    opens[: len(near)] |= (near % np.uint64(mark) == 0) & inside
    head = np.flatnonzero(opens)
    last = np.append(text[head[1:]] != text[head[:-1]], True)
    stop = np.append(head[1:], len(starts)) + np.where(last, 0, lap)
    left = tail[head] - sizes[head] + 1
    return text[head], _strings(flat, left, tail[stop - 1] - left), last


def _parse(width: int, mark: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            text, chunk, last = parse(part.column("text"), width, mark)
            lang = part.column("lang").take(pa.array(text))
            yield pa.RecordBatch.from_arrays([lang, chunk, pa.array(last)], names=["lang", "chunk", "last"])

    return run


def phrase_hashes(hashes: np.ndarray, size: int, lang: np.ndarray) -> np.ndarray:
    """Hash of each `size` consecutive words and the language of the first one."""
    n = max(0, len(hashes) - size + 1)
    return mix(run_hashes(hashes, size) ^ lang[:n])


def _count(size: int, width: int, table: object):
    """Weighted counts of the phrases of `size` words that chunks own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if table is None else np.frombuffer(table.value, np.uint8)
        for part in slices(batches, "chunk", SLICE):
            w = words(part.column("chunk"))
            total = len(w.starts)
            row = np.repeat(np.arange(part.num_rows), np.diff(w.first))
            langs = part.column("lang_key").to_numpy().view(np.uint64)[row]
            weight = part.column("n").to_numpy()
            last = part.column("last").to_numpy(zero_copy_only=False)
            hashes = w.hashes()
            # Words before the end of a piece, or of the chunk.
            ends = np.append(w.data, np.uint8(10))[w.ends] == 10
            ends[w.first[1:][np.diff(w.first) > 0] - 1] = True
            edge = np.flatnonzero(ends)
            room = edge[np.searchsorted(edge, np.arange(total))] + 1 - np.arange(total)
            owned = w.first[1:] - np.where(last, 0, width - 1)
            good = (room >= size) & (np.arange(total) < owned[row])
            if bits is not None:
                held = phrase_hashes(hashes, size - 1, langs) & np.uint64(len(bits) * 8 - 1)
                known = (bits[held >> np.uint64(3)] >> (held & np.uint64(7)).astype(np.uint8)) & 1 > 0
                at = np.flatnonzero(good)
                at = at[known[at] & known[at + 1]]
            else:
                at = np.flatnonzero(good)
            key = phrase_hashes(hashes, size, langs)[at]
            _, pick, inverse = np.unique(key, return_index=True, return_inverse=True)
            f = np.zeros(len(pick), dtype=np.int64)
            np.add.at(f, inverse, weight[row[at]])
            one = at[pick]
            phrase = _strings(w.data, w.starts[one], w.ends[one + size - 1] - w.starts[one])
            lang = part.column("lang").take(pa.array(row[one]))
            yield pa.RecordBatch.from_arrays([lang, phrase, pa.array(f)], names=["lang", "phrase", "f"])

    return run


def _cells(size: int, bits: int):
    """Bit numbers of frequent phrases of `size` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            hashes = words(part.column("phrase")).hashes()
            langs = np.repeat(part.column("lang_key").to_numpy().view(np.uint64), size)
            held = phrase_hashes(hashes, size, langs)[::size] & np.uint64(bits - 1)
            yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int64))], names=["cell"])

    return run


def _table(frequent: DataFrame, size: int, bits: int):
    """The bits of frequent phrases, broadcast: bits / 8 bytes whatever their number."""
    spark = frequent.sparkSession
    # Bucket b of Spark's bitmaps holds the values from 32768 (b - 1) + 1 on.
    value = F.col("cell") + 1
    cells = frequent.select("phrase", F.xxhash64("lang").alias("lang_key"))
    maps = (
        cells.mapInArrow(_cells(size, bits), "cell long")
        .groupBy(F.bitmap_bucket_number(value).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
    )
    out = np.zeros((max(1, bits // _BITMAP), _BITMAP // 8), dtype=np.uint8)
    for bucket, found in maps.collect():
        out[bucket - 1] = np.frombuffer(found, np.uint8)
    return spark.sparkContext.broadcast(out.tobytes()[: bits // 8])


def phrase_counts(
    docs: DataFrame,
    width: int = WORDS,
    least: int = LEAST,
    lang_col: str = "lang",
    text_col: str = "text",
    mark: int = MARK,
    bits: int = BITS,
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of the phrases of 1 to `width` words with f >= `least`
    occurrences, and (lang, n): the words of each language."""
    texts = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    chunks = texts.mapInArrow(_parse(width, mark), "lang string, chunk string, last boolean")
    counted = chunks.groupBy("lang", "chunk", "last").agg(F.count("*").alias("n"))
    parsed = stored(counted.withColumn("lang_key", F.xxhash64("lang")), "chunks")
    sizes, n, table = [], None, None
    for size in range(1, width + 1):
        found = (
            parsed.mapInArrow(_count(size, width, table), "lang string, phrase string, f long")
            .groupBy("lang", "phrase")
            .agg(F.sum("f").alias("f"))
        )
        if size == 1:
            found = stored(found, "words")
            n = stored(found.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
        frequent = stored(found.where(F.col("f") >= least), f"phrases-{size}")
        sizes.append(frequent.withColumn("size", F.lit(size)))
        if size < width:
            table = _table(frequent, size, bits)
    out = sizes[0]
    for more in sizes[1:]:
        out = out.unionByName(more)
    return out, n


def _part(words_: str, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words_, start, size), " ")


def collocations(
    docs: DataFrame,
    width: int = WORDS,
    least: int = LEAST,
    first: int = FIRST,
    absorb: int = 100,
    lang_col: str = "lang",
    text_col: str = "text",
    mark: int = MARK,
    bits: int = BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `first` best phrases of each language.

    Texts are lower-cased (A-Z) and cut into pieces at . , ; : ! ? and line ends, pieces into
    words at blanks and tabs. f counts all occurrences of a phrase within pieces, n the words of
    the language (null: `und`). A phrase of 2 to `width` words with a = f >= `least` scores
    floor(1000 a n / (l r)) at the cut into two parts, with l and r occurrences, that scores
    lowest; ties go to the shorter first part. Phrases inside a longer frequent one with
    100 f(longer) >= `absorb` a are left out. Order: score and a falling, then phrase in byte
    order. Products are exact up to 10^38. Null and empty texts have no words; repeated rows
    count as often as they stand; ids and other columns do not matter.
    """
    grams, n = phrase_counts(docs, width, least, lang_col, text_col, mark, bits)
    several = grams.where("size > 1").select(
        "lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("words")
    )
    cuts = several.select(
        "lang", "phrase", "size", "a", "words",
        F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k",
        _part("words", F.lit(1), F.col("k")).alias("left"),
        _part("words", F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    left = grams.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = grams.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(n, "lang")
    score = F.expr(
        "cast(1000 as decimal(38, 0)) * cast(a as decimal(38, 0)) * cast(n as decimal(38, 0))"
        " div (cast(l as decimal(38, 0)) * cast(r as decimal(38, 0)))"
    )
    lowest = (
        scored.select("lang", "phrase", "a", "n", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min("cut").alias("cut"))
    )
    inner = (
        several.where("size > 2")
        .select("lang", "a", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
        .select(
            "lang", "a", "words", "m",
            F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("i"),
        )
        .groupBy("lang", _part("words", F.col("i"), F.col("m")).alias("phrase"))
        .agg(F.max("a").alias("longer"))
    )
    absorbed = 100 * F.coalesce("longer", F.lit(0)) >= absorb * F.col("a")
    kept = lowest.join(inner, ["lang", "phrase"], "left").where(~absorbed | F.col("longer").isNull())
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= first)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
