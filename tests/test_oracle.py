"""Every registered query against its DuckDB oracle, on the smallest tables."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as ent
from tests.conftest import SF001

DRIVER = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (dt.date, decimal.Decimal)):
        return str(v)
    return "NULL" if v is None else str(v)


def _norm(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for n in DRIVER:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{os.path.join(SF001, n)}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SF001)
    got = _norm(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(ent.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _norm(cols, res.fetchall())


# sequential rule (see allocation.py); checked against a brute-force fold instead
def test_every_query_of_the_model_has_an_oracle():
    from shelflife.plans.oracle import oracle_queries
    from shelflife.plans.registry import spark_queries
    assert set(spark_queries()) == set(oracle_queries())


def test_entry(spark):
    df = ent.entry(spark)
    assert df.columns[:4] == ["warehouse_id", "warehouse_name", "region", "total_revenue"]
    assert df.count() == 5
