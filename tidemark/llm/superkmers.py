"""Repeated passages: windows of words, counted exactly in buckets of super-k-mers.

A window is `WINDOW` consecutive words. Its minimiser is the smallest hash among its runs of
`RUN` words. Consecutive windows that share a minimiser form a super-k-mer: one packed
string of their words, sent once to the minimiser's bucket. In a bucket, equal windows meet
whole; sorting brings them together, and all but those of the smallest id are marked.

Two things keep a bucket small whatever the corpus repeats. Runs that many documents share
are found in a first pass and ranked last, so a window has such a minimiser only if it lies
wholly inside shared passages. And before anything is sent, windows that a batch holds
several times are decided within the batch, so each batch sends them once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import stored
from tidemark.llm.textbatch import mix, powers, ragged, slices, words

WINDOW, RUN = 50, 4
#: Bytes of text whose repeats one task decides before sending.
SENT = 4 << 20
#: Windows of one bucket.
BUCKET = 1 << 19
#: Most minimisers that are ranked last; they go to every task.
HEAVY = 1 << 20
_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))


def run_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of h[i:i + width] for every i where it fits."""
    n = max(0, len(h) - width + 1)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * _BASE + h[k : k + n]
    return mix(out)


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """The same from running sums, for wide windows."""
    n = max(0, len(h) - width + 1)
    total = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * powers(_BASE, len(h)), out=total[1:])
    return mix((total[width : width + n] - total[:n]) * powers(_BACK, n))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of x[i:i + width] for every i where it fits."""
    n, span = len(x) - width + 1, 1
    while 2 * span <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[:n], x[width - span : width - span + n])


def minimisers(
    h: np.ndarray, first: np.ndarray, heavy: np.ndarray, window: int, run: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every window: its first word, its minimiser's hash and that run's first word.

    Windows never cross from one text to the next. `heavy` (sorted) holds hashes ranked last.
    """
    sizes = np.maximum(np.diff(first) - window + 1, 0)
    at = ragged(first[:-1], sizes)
    if not len(at):
        return at, np.zeros(0, np.uint64), at
    grams = run_hashes(h, run) >> np.uint64(1)
    if len(heavy):
        slot = np.minimum(np.searchsorted(heavy, grams), len(heavy) - 1)
        grams |= (heavy[slot] == grams).astype(np.uint64) << np.uint64(63)
    # Rank by the hash's upper bits; among equal ones the leftmost run.
    bits = np.uint64(max(1, int(len(grams)).bit_length()))
    order = (grams >> bits) << bits | np.arange(len(grams), dtype=np.uint64)
    low = sliding_min(order, window - run + 1)[at]
    where = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return at, grams[where], where


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of up to `SENT` bytes of text, gathered over small batches."""
    held: list[pa.RecordBatch] = []
    size = 0
    for part in slices(batches, "text", SENT):
        size += part.nbytes
        held.append(part)
        if size >= SENT:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _counts(window: int, run: int):
    """Super-k-mers and windows of each minimiser of a batch; a null one for all together."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _batches(batches):
            w = words(part.column("text"))
            _, gram, where = minimisers(w.hashes(), w.first, np.zeros(0, np.uint64), window, run)
            new = np.ones(len(where), dtype=bool)
            new[1:] = where[1:] != where[:-1]
            value, count = np.unique(gram[new], return_counts=True)
            names = pa.array(np.append(value, np.uint64(0)).view(np.int64))
            known = pa.array(np.append(np.ones(len(value), bool), False))
            yield pa.RecordBatch.from_arrays(
                [
                    pc.if_else(known, names, pa.scalar(None, pa.int64())),
                    pa.array(np.append(count, count.sum()).astype(np.int64)),
                    pa.array(np.append(np.zeros(len(value), np.int64), len(gram))),
                ],
                names=["gram", "packs", "windows"],
            )

    return work


def repeats(
    key: np.ndarray, doc: np.ndarray, h: np.ndarray, at: np.ndarray, window: int
) -> np.ndarray:
    """Which windows h[at:at + window] also start in a document with a smaller id.

    `key` are their hashes. Windows of one hash are compared word by word.
    """
    order = np.lexsort((doc, key))
    k, d, a = key[order], doc[order], at[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
    later = np.flatnonzero(~new)
    alike = np.ones(len(later), dtype=bool)
    for i in range(window):
        alike &= h[a[later] + i] == h[a[head[later]] + i]
    found = np.zeros(len(k), dtype=bool)
    found[later] = d[later] > d[head[later]]
    for top in np.unique(head[later[~alike]]).tolist():
        lowest: dict[bytes, int] = {}
        for i in np.flatnonzero(head == top).tolist():
            own = h[a[i] : a[i] + window].tobytes()
            found[i] = d[i] > lowest.setdefault(own, d[i])
    flags = np.zeros(len(k), dtype=bool)
    flags[order] = found
    return flags


def spans(text: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Text, first and last + 1 word of the merged ranges that windows at words `at` cover."""
    order = np.lexsort((at, text))
    text, at = text[order], at[order]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] > at[:-1] + window) | (text[1:] != text[:-1])
    last = np.append(new[1:], True)[: len(at)]
    return text[new], at[new], at[last] + window


_SENT = "bucket long, n int, packed binary"
_FOUND = "doc_id long, row_key long, start long, stop long"


def _send(window: int, run: int, heavy: np.ndarray, buckets: int):
    """Super-k-mers by bucket; a negative bucket: ranges that the batch has decided itself."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=6)

        def rows(bucket, n, packed) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket, pa.int64()), pa.array(n, pa.int32()), pa.array(packed, pa.binary())],
                names=["bucket", "n", "packed"],
            )

        for part in _batches(batches):
            w = words(part.column("text"))
            h = w.hashes()
            at, gram, where = minimisers(h, w.first, heavy, window, run)
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            keys = part.column("row_key").to_numpy(zero_copy_only=False)
            text = np.searchsorted(w.first, at, side="right") - 1
            decided = repeats(window_hashes(h, window)[at], ids[text], h, at, window)
            owner, a, b = spans(text[decided], (at - w.first[text])[decided], window)
            if len(a):
                head = np.stack((ids[owner], keys[owner], a, b))
                place = -1 - int(mix(keys[owner[:1]].view(np.uint64))[0] % np.uint64(buckets))
                yield rows([place], [len(a)], [press.compress(head.tobytes())])
            # A super-k-mer: consecutive windows with one minimiser, from the first undecided
            # one to the last. Decided ones in between go along.
            new = np.ones(len(at), dtype=bool)
            new[1:] = (where[1:] != where[:-1]) | (text[1:] != text[:-1])
            open_ = np.flatnonzero(~decided)
            _, s = np.unique((np.cumsum(new) - 1)[open_], return_index=True)
            first, last = open_[s], open_[np.append(s[1:], len(open_))[: len(s)] - 1]
            bucket = (mix(gram[first]) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first, last, bucket = first[order], last[order], bucket[order]
            owner = text[first]
            x, y = w.starts[at[first]], w.ends[at[last] + window - 1]
            facts = np.stack((ids[owner], keys[owner], at[first] - w.first[owner], y - x))
            raw = w.data.tobytes()
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else []
            cuts = [*np.asarray(cuts).tolist(), len(bucket)]
            out: tuple[list, list, list] = ([], [], [])
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                parts = [raw[p:q] for p, q in zip(x[i:j].tolist(), y[i:j].tolist(), strict=True)]
                out[0].append(int(bucket[i]))
                out[1].append(j - i)
                out[2].append(press.compress(facts[:, i:j].tobytes() + b"".join(parts)))
            yield rows(*out)

    return work


def _bucket(window: int):
    def work(group: pd.DataFrame) -> pd.DataFrame:
        unpress = zstandard.ZstdDecompressor()
        facts, texts = [], []
        if group["bucket"].iloc[0] < 0:
            for n, packed in zip(group["n"], group["packed"], strict=True):
                facts.append(np.frombuffer(unpress.decompress(packed), np.int64).reshape(4, n))
            names = ["doc_id", "row_key", "start", "stop"]
            return pd.DataFrame(dict(zip(names, np.concatenate(facts, axis=1), strict=True)))
        for n, packed in zip(group["n"], group["packed"], strict=True):
            raw = unpress.decompress(packed)
            facts.append(np.frombuffer(raw, np.int64, 4 * n).reshape(4, n))
            texts.append(raw[32 * n :])
        ids, keys, start, size = np.concatenate(facts, axis=1)
        ends = np.concatenate(([0], np.cumsum(size)))
        w = words(
            pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(texts))]
            )
        )
        h = w.hashes()
        at = ragged(w.first[:-1], np.maximum(np.diff(w.first) - window + 1, 0))
        text = np.searchsorted(w.first, at, side="right") - 1
        found = repeats(window_hashes(h, window)[at], ids[text], h, at, window)
        at, text = at[found], text[found]
        # Ranges of one document meet again in the join; here they only need to be few.
        owner, a, b = spans(text, at - w.first[text] + start[text], window)
        return pd.DataFrame({"doc_id": ids[owner], "row_key": keys[owner], "start": a, "stop": b})

    return work


def repeated_ranges(
    docs: DataFrame, window: int = WINDOW, run: int = RUN, bucket: int = BUCKET
) -> DataFrame:
    """(doc_id, row_key, start, stop): word ranges covered by windows that also start in a
    document with a smaller id. `docs` has doc_id (long, not null), row_key and text.
    Ranges of a document may overlap."""
    spark = docs.sparkSession
    grams = docs.select("text").mapInArrow(
        _counts(window, run), "gram long, packs long, windows long"
    )
    often = stored(
        grams.groupBy("gram")
        .agg(F.sum("packs").alias("packs"), F.sum("windows").alias("windows"))
        .where("gram is null or packs >= 32"),
        "minimisers",
    )
    total = often.where("gram is null").agg(F.sum("packs"), F.sum("windows")).first()
    packs, windows = total[0] or 0, total[1] or 0
    buckets = max(windows // bucket + 1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # At most HEAVY minimisers can have so many super-k-mers.
    bound = max(packs / (2 * buckets), packs / HEAVY)
    rows = often.where(F.col("gram").isNotNull() & (F.col("packs") > bound)).select("gram")
    heavy = np.sort(rows.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))
    sent = docs.select("doc_id", "row_key", "text").mapInArrow(
        _send(window, run, heavy, buckets), _SENT
    )
    return sent.groupBy("bucket").applyInPandas(_bucket(window), _FOUND)


def _keep(texts: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            w = words(part.column("text"))
            raw = w.data.tobytes()
            counts, removed, kept, sums = np.diff(w.first), [], [], []
            starts, ends = w.starts.tolist(), w.ends.tolist()
            for i, ranges in enumerate(part.column("ranges").to_pylist()):
                s, e = int(w.first[i]), int(w.first[i + 1])
                keep = np.ones(e - s, dtype=bool)
                for r in ranges or ():
                    keep[r["start"] : r["stop"]] = False
                left = (np.flatnonzero(keep) + s).tolist()
                own = b" ".join([raw[starts[k] : ends[k]] for k in left])
                removed.append(e - s - len(left))
                sums.append(hashlib.sha256(own).hexdigest())
                kept.append(own)
            columns = [
                part.column("row_key"), pa.array(counts), pa.array(removed, pa.int64()),
                pa.array(sums, pa.string()),
            ]
            names = ["row_key", "n_words", "n_removed", "kept_sha256"]
            if texts:
                columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *columns], names=["doc_id", *names]
            )

    return work


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    texts: bool = True,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per document: doc_id, row_key, n_words, n_removed, kept_sha256 (and kept_text).

    Removes each word that is covered by a window whose words also start in a document with a
    smaller id. Kept words are joined by one space. A null text has no words. Documents
    without an id keep all words and remove none elsewhere; rows that repeat an id are never
    compared with each other, and each gets a row. row_key is a hash of id and text.
    """
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(id_col).cast("long"), F.coalesce(text_col, F.lit(""))).alias("row_key"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    found = repeated_ranges(keyed.where("doc_id is not null"), window, bucket=bucket)
    ranges = found.groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("start", "stop")).alias("ranges")
    )
    kinds = "doc_id long, row_key long, n_words long, n_removed long, kept_sha256 string"
    return keyed.join(stored(ranges, "ranges"), ["doc_id", "row_key"], "left").mapInArrow(
        _keep(texts), kinds + (", kept_text string" if texts else "")
    )
