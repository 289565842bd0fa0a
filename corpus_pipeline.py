"""From raw documents to packed token sequences, in five stages over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, minhash, mixing, packing, secretscan
from tidemark.llm.queries import table, tokenizer
from tidemark.llm.storage import free_name, ship_package, stored

#: A text of at least so many characters of which no language claims this share is no text.
LEAST_SHARE, LEAST_CHARS = 0.2, 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: rejects those without letters and those that no
    language claims. The languages are learned from the documents' own labels."""
    columns = docs.columns
    found = langid.identify(docs, langid.fit(docs))
    foreign = (F.col("score") < LEAST_SHARE) & (F.length("text") >= LEAST_CHARS)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & ~foreign).select(columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    columns = docs.columns
    kept = minhash.near_duplicates(docs).where("kept").select(columns)
    # Rows that repeat an id are one document, of which the first by its columns stays, the text
    # before the others; those without an id are all their own.
    own = free_name(kept, "own")
    nameless = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    order = sorted(columns, key=lambda c: (c != "doc_id", c != "text"))
    row = F.struct(*(F.col(f"`{c}`") for c in order))
    ordered = not any(k in kept.schema.simpleString() for k in ("map<", "variant"))
    # Maps have no order; their text has one.
    first = F.min(row) if ordered else F.min_by(row, F.to_json(row))
    named = kept.withColumn(own, nameless).groupBy("doc_id", own).agg(first.alias("row"))
    return named.select(*(F.col(f"row.`{c}`").alias(c) for c in columns))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with a mark in place of each secret."""
    columns = docs.columns
    clean = secretscan.scan_secrets(docs).withColumn("text", F.col("clean_text"))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(columns)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by tempered source weights, as many tokens as before; a row for each use."""
    return mixing.mix_sources(docs).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all token pieces in sequences of 2048."""
    return packing.pack(packing.token_pieces(docs, tokenizer("byte_bpe_50k.json")))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no tokenizer and no MinHash; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
