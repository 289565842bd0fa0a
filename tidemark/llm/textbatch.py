"""Texts of an Arrow batch as numpy arrays: bytes, words and 64-bit word hashes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space of the word rule: space and 0x09-0x0D.
WHITE = np.zeros(256, dtype=bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True

_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, size=256, dtype=np.uint64)
_LOWERED = _BYTE.copy()
_LOWERED[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes hashed at once.
_SPAN = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWERS, _INVERSES = powers(_BASE, _SPAN + 1), powers(_INVERSE, _SPAN + 1)


def range_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTE
) -> np.ndarray:
    """64-bit hash of data[start:end] for ascending ranges that do not overlap."""
    global _POWERS, _INVERSES
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + _SPAN, side="right")))
        span = int(ends[j - 1] - base)
        up, down = _POWERS, _INVERSES
        if span >= len(up):
            up, down = powers(_BASE, span + 1), powers(_INVERSE, span + 1)
        total = np.zeros(span + 1, dtype=np.uint64)
        np.cumsum(table[data[base : base + span]] * up[:span], out=total[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its len + 1 offsets. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "") if column.null_count else column
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The rows in order, in slices of at most `limit` bytes of text or one text alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        i = 0
        while i < len(sizes):
            j = max(i + 1, int(np.searchsorted(total, total[i] + limit, side="right")) - 1)
            yield batch.slice(i, j - i)
            i = j


class Words(NamedTuple):
    """Words of the texts of a batch, in order. Text i has words first[i]:first[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        return range_hashes(self.data, self.starts, self.ends, _LOWERED if lower else _BYTE)


def words(column: pa.Array) -> Words:
    """Maximal runs without white space; a word never crosses from one text to the next."""
    data, at = text_bytes(column)
    n = len(data)
    full = ~WHITE[data]
    begin = np.ones(n + 1, dtype=bool)
    begin[1:n] = ~full[: n - 1] if n else begin[1:n]
    begin[at] = True
    starts = np.flatnonzero(full & begin[:n])
    after = np.ones(n, dtype=bool)
    after[: max(n - 1, 0)] = ~full[1:]
    inner = at[(at > 0)] - 1
    after[inner] = True
    ends = np.flatnonzero(full & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    out = np.ones(total, dtype=np.int64)
    kept = lengths > 0
    starts, lengths = starts[kept], lengths[kept]
    if not total:
        return out
    at = np.cumsum(lengths)[:-1]
    out[0] = starts[0]
    out[at] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(out)
