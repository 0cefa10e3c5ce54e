"""Queries of this subpackage against their own SQL."""

import os

import duckdb
import pytest

from lexmill.llm import queries

DATA = os.environ.get("LEXMILL_TESTDATA", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    df = queries.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    want = con.sql(queries.oracle_sql()[name])
    assert sorted(want.columns) == columns
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    want = sorted((tuple(value(dict(zip(want.columns, r))[c]) for c in columns) for r in want.fetchall()), key=repr)
    assert sorted((tuple(value(r[c]) for c in columns) for r in df.collect()), key=repr) == want
