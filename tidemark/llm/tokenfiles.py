"""Token ids as Arrow files of equal-length sequences with masks.

A file in Arrow's file format holds record batches with two fixed-size-list columns, `ids`
and `mask`. Batches are uncompressed and, but for the last, equally long, so sequence i of a
memory-mapped file is a view at a computed place. Beside it, an index file has each
document's place. Files are written by tasks under names of their own; the table of the
files that count is what the Spark job commits, so a repeated task leaves nothing behind
that is read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyarrow import ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.storage import scratch, stored
from tidemark.llm.textbatch import slices
from tidemark.llm.tokens import encoder

LENGTH = 2048
#: Sequences of one record batch.
BATCH = 256
_FILES = "part int, ids_file string, docs_file string, n_ids long, n_docs long"


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; `file:/x` is written as `file:///x`."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


class SequenceWriter:
    """Writes a run of ids as sequences of `length`; the last one is padded, its mask false there."""

    def __init__(self, sink, length: int, kind: pa.DataType):
        self.length, self.kind = length, kind
        self.schema = pa.schema(
            [("ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))],
            metadata={"length": str(length), "batch": str(BATCH)},
        )
        self.writer = ipc.new_file(sink, self.schema)
        self.rest: list[np.ndarray] = []
        self.held = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.rest.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        step = self.length * BATCH
        if self.held >= step:
            run = np.concatenate(self.rest)
            for i in range(0, len(run) - step + 1, step):
                self._write(run[i : i + step], step)
            self.rest = [run[len(run) - len(run) % step :]]
            self.held = len(self.rest[0])

    def _write(self, run: np.ndarray, size: int) -> None:
        ids = np.zeros(size, dtype=self.kind.to_pandas_dtype())
        ids[: len(run)] = run
        columns = [ids, np.arange(size) < len(run)]
        self.writer.write_batch(
            pa.RecordBatch.from_arrays(
                [
                    pa.FixedSizeListArray.from_arrays(pa.array(c), type=f.type)
                    for c, f in zip(columns, self.schema, strict=True)
                ],
                schema=self.schema,
            )
        )

    def close(self) -> None:
        if self.held:
            self._write(np.concatenate(self.rest), -(-self.held // self.length) * self.length)
        self.writer.close()


class Sequences:
    """Random access to the sequences of a file: file[i] is (ids, mask), views where mapped."""

    def __init__(self, folder: str, name: str):
        where, path = _place(folder)
        source = (
            pa.memory_map(f"{path}/{name}")
            if isinstance(where, fs.LocalFileSystem)
            else where.open_input_file(f"{path}/{name}")
        )
        self.file = ipc.open_file(source)
        self.length = int(self.file.schema.metadata[b"length"])
        self.batch = int(self.file.schema.metadata[b"batch"])
        n = self.file.num_record_batches
        self.size = (n - 1) * self.batch + self.file.get_batch(n - 1).num_rows if n else 0

    def __len__(self) -> int:
        return self.size

    def __getitem__(self, i: int) -> tuple[pa.Array, pa.Array]:
        if not 0 <= i < self.size:
            raise IndexError(i)
        batch = self.file.get_batch(i // self.batch)
        return tuple(c[i % self.batch].values for c in batch.columns)

    def runs(self) -> Iterator[np.ndarray]:
        """The ids of each record batch, in order."""
        for k in range(self.file.num_record_batches):
            yield self.file.get_batch(k).column(0).flatten().to_numpy(zero_copy_only=True)


def _write(folder: str, path: str, end_id: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        top = max(end_id, coder.tokenizer.get_vocab_size() - 1)
        where, root = _place(folder)
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        ids_file, docs_file = f"ids-{part:05d}-{name}.arrow", f"docs-{part:05d}-{name}.arrow"
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        writer = index = None
        n_docs = 0
        for rows in slices(batches, "text"):
            if writer is None:
                where.create_dir(root)
                sinks = [where.open_output_stream(f"{root}/{x}") for x in (ids_file, docs_file)]
                writer = SequenceWriter(
                    sinks[0], length, pa.uint16() if top < 1 << 16 else pa.uint32()
                )
                index = ipc.new_file(sinks[1], schema)
            ids, sizes = coder.encode(rows.column("text"))
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            sizes = sizes + 1
            starts = writer.total + np.cumsum(sizes) - sizes
            writer.add(ids)
            columns = [rows.column("doc_id"), pa.array(starts), pa.array(sizes)]
            index.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
            n_docs += len(sizes)
        if writer is not None:
            writer.close()
            index.close()
            for sink in sinks:
                sink.close()
            row = [[part], [ids_file], [docs_file], [writer.total], [n_docs]]
            kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds, strict=True)],
                names=["part", "ids_file", "docs_file", "n_ids", "n_docs"],
            )

    return run


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str | None = None,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[str, DataFrame]:
    """Folder and table of the files: part, ids_file, docs_file, n_ids, n_docs, first_id.

    Documents go in ascending id order (null ids first; rows of one id by text), from file to
    file by `part`. first_id counts the ids in the files before. A null text is empty; each
    document gets `end_id`. An empty table gives no file. `tokenizer` is the path of a
    `tokenizers` file on every machine; the folder must be shared by all machines.
    """
    folder = folder or f"{scratch(docs.sparkSession, 'tokens')}"
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    files = stored(
        ordered.select("doc_id", "text").mapInArrow(
            _write(folder, tokenizer, end_id, length), _FILES
        ),
        "files",
    )
    # One row a file.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return folder, files.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _place(folder)
        for batch in batches:
            for f in batch.to_pylist():
                runs = Sequences(folder, f["ids_file"]).runs()
                run, at = np.zeros(0, np.uint16), 0
                with where.open_input_file(f"{root}/{f['docs_file']}") as source:
                    index = ipc.open_file(source)
                    for k in range(index.num_record_batches):
                        part = index.get_batch(k)
                        sums = []
                        for n in part.column("n_tokens").to_pylist():
                            crc = 0
                            while n:
                                if at == len(run):
                                    run, at = next(runs), 0
                                own = run[at : at + n]
                                crc = zlib.crc32(own.astype("<u4").tobytes(), crc)
                                at, n = at + len(own), n - len(own)
                            sums.append(crc)
                        start = part.column("start").to_numpy() + f["first_id"]
                        yield pa.RecordBatch.from_arrays(
                            [part.column("doc_id"), pa.array(start), part.column("n_tokens"),
                             pa.array(sums, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return run


def read_tokens(folder: str, files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32 (little-endian 32-bit ids)."""
    n = files.count()
    return files.repartition(max(1, n)).mapInArrow(
        _read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
