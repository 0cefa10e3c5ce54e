"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from lexmill.plans import catalogue, composed, lookups, records, stems  # noqa: F401

DATA = os.environ.get("LEXMILL_TESTDATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return c


def plain(rows, columns):
    value = lambda v: round(float(v), 8) if isinstance(v, float) else v
    return sorted((tuple(value(r[c]) for c in columns) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_rows(spark, con, name):
    df = catalogue.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    want = con.sql(catalogue.SQL[name])
    assert sorted(want.columns) == columns
    want = [dict(zip(want.columns, r)) for r in want.fetchall()]
    assert plain([r.asDict() for r in df.collect()], columns) == plain(want, columns)
