"""Every registered query against its DuckDB SQL (row count, column names,
order-insensitive value hash), at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from quarry.plans.registry import QUERIES, TABLES
from tools.oracle_check import digest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "o_orderkey" in df.columns


def test_every_query_has_an_oracle_or_is_listed():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 0
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    expected = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(expected)
    assert digest(df.columns, rows)[0] == digest(cols, expected)[0]
