"""Every named query against DuckDB on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from workload.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else repr(v)
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, db, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    expected = db.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in expected.description}
    rows = expected.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types
    got = canonical(df.collect(), df.columns)
    want = canonical(rows, columns)
    assert len(got) == len(want)
    assert want or "sf0.01" not in sf_dir
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()
