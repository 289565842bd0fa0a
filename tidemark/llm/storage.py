"""Intermediate tables in the shared folder: they cut lineage and outlive executors."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.textbatch import slices
from tidemark.session import scratch_dir


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_dir(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df`, written once as Parquet in the shared folder and read from there."""
    spark, schema = df.sparkSession, df.schema
    path = f"{scratch(spark, name)}/rows"
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship_package(spark: SparkSession) -> None:
    """In local mode, lets Python workers import this package from any working directory.

    On a cluster, submit the package with --py-files or install it on the machines.
    """
    if spark.sparkContext.master.startswith(("local[", "local*")) or (
        spark.sparkContext.master == "local"
    ):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        spark.sparkContext.addFile(package, recursive=True)


def map_texts(
    docs: DataFrame,
    text_col: str,
    work: Callable[[pa.Array], list[pa.Array]],
    made: str,
    keep_text: bool = True,
) -> DataFrame:
    """`docs` with the columns `made` (a schema) that `work` computes from slices of its texts.

    The other columns go along untouched, whatever their names and types; those named as a
    made column are replaced. The text column itself comes back only with `keep_text`.
    """
    new = StructType.fromDDL(made).fieldNames()
    lower = {c.lower() for c in new}
    kept = [c for c in docs.columns if c != text_col and c.lower() not in lower]
    # Fields by place, so that any names go along.
    text, places = "text_in", {c: f"c{i}" for i, c in enumerate(kept)}
    rows = docs.select(
        F.col(f"`{text_col}`").cast("string").alias(text),
        F.struct(
            F.lit(True).alias("row"), *(F.col(f"`{c}`").alias(p) for c, p in places.items())
        ).alias("others"),
    )
    schema = StructType(
        [rows.schema["others"], *([rows.schema[text]] if keep_text else []),
         *StructType.fromDDL(made).fields]
    )
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            own = [part.column("others"), *([part.column(text)] if keep_text else [])]
            yield pa.RecordBatch.from_arrays([*own, *work(part.column(text))], names=names)

    out = rows.mapInArrow(run, schema)
    shown = [c for c in docs.columns if c in places or (keep_text and c == text_col)]
    return out.select(
        *(F.col(f"others.{places[c]}" if c in places else text).alias(c) for c in shown),
        *(F.col(f"`{c}`") for c in new),
    )
