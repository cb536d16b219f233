"""Every registered query against its DuckDB oracle (rows, names, order-free values)."""
import math

import duckdb
import pytest

import __spark_entry__ as E
from webfoot.plans import oracle, queries
from webfoot.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
QUERIES = queries.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(_norm(r[c]) for c in cols)) for r in df.collect())
    rel = con.execute(SQL[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = sorted(repr(tuple(_norm(r[i]) for i in idx)) for r in rel.fetchall())
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "url" in df.columns
