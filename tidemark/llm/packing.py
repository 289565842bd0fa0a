"""Best-fit packing of token pieces into sequences, after dominance reduction.

Only the number of pieces of each length matters for a plan, and there are at most
`capacity` lengths, whatever the corpus. The plan is made on the driver from those counts:
bins that provably belong to some best packing are fixed first (Martello and Toth), the
remainder is packed by best fit, longest first. Pieces then take the places of their
length by rank; ranks are dealt over many groups, so a very common length is not one task.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import free_name, stored
from tidemark.llm.textbatch import slices
from tidemark.llm.tokens import encoder

CAPACITY = 2048
#: Pieces of one length that one task ranks.
RANKED = 100_000


class Bins(NamedTuple):
    """`times` equal bins; `items` are (length, copies in each bin)."""

    times: int
    items: tuple[tuple[int, int], ...]


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> tuple[list[Bins], np.ndarray]:
    """Bins that some best packing has, and the counts that remain. counts[l]: items of length l.

    For an item j and what may stand beside it, a set {j, ...} is fixed if any other set with j
    could be exchanged for it: every item, or pair that replaces one, fits in its place.
    """
    counts = counts.copy()
    fixed: list[Bins] = []

    def take(j: int, others: list[int]) -> bool:
        need = {x: [j, *others].count(x) for x in {j, *others}}
        times = min(int(counts[x]) // n for x, n in need.items())
        if times:
            for x, n in need.items():
                counts[x] -= n * times
            fixed.append(Bins(times, tuple(sorted(need.items(), reverse=True))))
        return times > 0

    lengths = np.arange(capacity + 1)
    for j in range(capacity, 0, -1):
        while counts[j] > 0:
            room = capacity - j
            counts[j] -= 1
            there = counts > 0
            up_to = np.maximum.accumulate(np.where(there, lengths, 0))
            small: list[int] = []
            for x in np.flatnonzero(there)[:3].tolist():
                small += [x] * min(3 - len(small), int(counts[x]))
            most = sum(1 for i in range(len(small)) if sum(small[: i + 1]) <= room)
            best = int(up_to[room]) if room else 0
            x = np.flatnonzero(there[: best + 1])
            y = up_to[np.minimum(x, room - x)]
            x, y = x[y > 0], y[y > 0]
            counts[j] += 1
            if most == 0:
                done = take(j, [])
            elif most == 1 or best == room:
                done = take(j, [best])
            elif most == 2:
                counts[[j, best]] -= np.array([1, 1]) if j != best else np.array([2, 2])
                beside = int(np.max(lengths[: room - best + 1] * (counts[: room - best + 1] > 0)))
                counts[[j, best]] += np.array([1, 1]) if j != best else np.array([2, 2])
                if np.all(x + y <= best):
                    done = take(j, [best])
                elif beside and np.all((y <= beside) | (x + y <= best)):
                    done = take(j, [best, beside])
                else:
                    break
            else:
                break
            if not done:
                break
    return fixed, counts


def best_fit(counts: np.ndarray, capacity: int) -> list[Bins]:
    """Best fit, longest first, on counts; equal bins are handled together."""
    rooms: list[int] = []
    held: dict[int, list[Bins]] = {}

    def put(room: int, bins: Bins) -> None:
        if bins.times:
            if room not in held:
                bisect.insort(rooms, room)
                held[room] = []
            held[room].append(bins)

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                bins = held[room].pop()
                if not held[room]:
                    del held[room], rooms[at]
            else:
                room, bins = capacity, Bins(left, ())
            each = room // length
            full = min(bins.times, left // each)
            put(room - each * length, Bins(full, (*bins.items, (length, each))))
            left -= full * each
            rest = bins.times - full
            if rest and 0 < left < each:
                put(room - left * length, Bins(1, (*bins.items, (length, left))))
                left, rest = 0, rest - 1
            if bins.items:
                put(room, Bins(rest, bins.items))
    return [b for group in held.values() for b in group]


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[Bins]:
    fixed, rest = reduce_by_dominance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def places(bins: list[Bins]) -> np.ndarray:
    """Rows (length, first rank, copies a bin, first sequence, first offset) by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, items in bins:
        offset = 0
        for length, copies in items:
            rank = used.get(length, 0)
            rows.append((length, rank, copies, sequence, offset))
            used[length] = rank + times * copies
            offset += copies * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _pieces(path: str, end_id: int, capacity: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for part in slices(batches, "text"):
            ids, sizes = encode(part.column("text"))
            rows, packed, at = [], [], 0
            for i, n in enumerate(sizes.tolist()):
                own = np.append(ids[at : at + n], np.uint32(end_id)).astype("<u4")
                at += n
                short = len(own) % capacity if len(own) > capacity else len(own)
                cuts = [0, *range(short or capacity, len(own) + 1, capacity)]
                for k, (s, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    raw = own[s:e].tobytes()
                    rows.append((i, k, s, e - s, zlib.crc32(raw)))
                    if keep_ids:
                        packed.append(raw)
            table = np.array(rows, dtype=np.int64)
            columns = [part.column("doc_id").take(pa.array(table[:, 0]))]
            columns += [pa.array(table[:, c]) for c in range(1, 5)]
            columns[1] = columns[1].cast(pa.int32())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                columns.append(pa.array(packed, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids, 4 bytes each).

    A document is its ids and then `end_id`; a null text is empty. Documents of more than
    `capacity` ids are cut into full pieces, of which the first may be shorter. `tokenizer`
    is the path of a `tokenizers` file on every machine.
    """
    kept = ", ids binary" if keep_ids else ""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")
    ).mapInArrow(
        _pieces(tokenizer, end_id, capacity, keep_ids),
        f"doc_id long, piece int, start long, length long, ids_crc32 long{kept}",
    )


def _placed(table: np.ndarray, place: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 1 << 40
        keys = table[:, 0] * width + table[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column(place).to_numpy()
            row = table[np.searchsorted(keys, length * width + rank, side="right") - 1]
            inner = rank - row[:, 1]
            rest = batch.select([c for c in batch.schema.names if c != place])
            yield pa.RecordBatch.from_arrays(
                [
                    *rest.columns,
                    pa.array(row[:, 3] + inner // row[:, 2]),
                    pa.array(row[:, 4] + inner % row[:, 2] * length),
                ],
                names=[*rest.schema.names, "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (doc_id, piece, length, ... of at most `capacity` each) with sequence_id, offset.

    Equal rows take different places. Sequences are gapless from offset 0. No pieces, no rows.
    Other columns go along, whatever their names; those named like the two new ones are replaced.
    """
    made = {"sequence_id", "offset"}
    pieces = stored(pieces.select(*(f"`{c}`" for c in pieces.columns if c.lower() not in made)), "pieces")
    found = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in found:
        counts[row["length"]] = row["n"]
    groups = max(64, int(counts.sum()) // RANKED)
    table = places(plan(counts, capacity))
    # Names that no column of the pieces has, so that any columns go along.
    group, inner, base, rank = (free_name(pieces, n) for n in ("group", "inner", "base", "rank"))
    dealt = pieces.withColumn(
        group, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    )
    sizes = dealt.groupBy("length", group).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy(group).rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = sizes.select(
        "length", group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base)
    )
    within = Window.partitionBy("length", group).orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn(inner, F.row_number().over(within) - 1)
        .join(sizes, ["length", group])
        .withColumn(rank, F.col(base) + F.col(inner))
        .select(*(F.col(f"`{c}`") for c in pieces.columns), rank)
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(_placed(table, rank), f"{schema}, sequence_id long, `offset` long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids) of packed pieces that kept their ids (4 bytes each)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(
        parts, F.lit("").cast("binary"), lambda all_, x: F.concat(all_, x["ids"])
    )
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), joined.alias("ids")
    )
