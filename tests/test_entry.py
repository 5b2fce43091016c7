"""Driver contract: every query runs and equals its DuckDB oracle on sf0.001."""

import datetime as dt
import decimal
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, decimal.Decimal):
        return "D" + format(v.normalize(), "f")
    if isinstance(v, bool):
        return "B" + str(v)
    if isinstance(v, int):
        return "D" + str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return "S" + str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from ledgerline.sources.fixtures import BASE_TABLES
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns[:5] == ["from_date", "to_date", "chapter", "ledger_account", "characteristic"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    import __spark_entry__ as e
    from ledgerline.plans.catalog import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())


def _names():
    from ledgerline.plans.catalog import QUERIES
    return sorted(QUERIES)


@pytest.mark.parametrize("name", _names())
def test_query_equals_oracle(spark, duck, name):
    import __spark_entry__ as e
    df = e.queries()[name](spark, SF)
    rel = duck.sql(e.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())
