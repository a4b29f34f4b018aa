"""Every registered query against its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001
from ledgerline.catalog import QUERIES
from tools.check_oracle import TABLES, norm, rows_key

# the optional training-data queries have tests of their own
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "total_sales_amount" in df.columns


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == sorted(cols)
    idx = [rel.columns.index(c) for c in cols]
    want = [tuple(r[i] for i in idx) for r in rel.fetchall()]
    assert len(got) == len(want)
    assert rows_key(got) == rows_key(want), norm
