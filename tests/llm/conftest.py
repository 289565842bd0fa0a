from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls, empty, white, short, very long and repeated texts, near copies."""
    rng = random.Random(5)
    base = sentence(rng, 200)
    words = base.split()
    near = " ".join([*words[:100], "other", *words[101:]])
    half = " ".join([*words[:110], *sentence(rng, 90).split()])
    texts = [
        None, "", " \n\t ", "one", "One", "one two three", base, base, base.upper(), near, half,
        sentence(rng, 30_000), f"x\ny  {base}", " ", "1234 %% !!", "a" * 5000,
    ]
    rows = [(i, t, "en", "src", len(t) if t else None) for i, t in enumerate(texts)]
    rows += [(40 + k, " ".join([*words[: 60 + 10 * k], sentence(rng, 60)]), None, None, 3) for k in range(8)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd_docs):
    """Extra columns that are named like those the operators make or use inside."""
    names = ["row", "others", "text_in", "row_key", "id", "a", "b", "Kept", "component_id", "score",
             "spans", "clean_text", "epoch", "weight", "h", "block", "name", "known", "ranges"]
    return odd_docs.select("*", *(F.lit("x").alias(n) for n in names))


@pytest.fixture(scope="session")
def without_ids(odd_docs):
    return odd_docs.withColumn("doc_id", F.lit(None).cast("long"))
