"""Every query against the same query in SQL, on the second smallest tables (the smallest fire no alerts)."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from signalwatch.plans.queries import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
# the optional training-data queries have tests of their own
QUERIES = {name: query for name, query in entry.queries().items() if name in REGISTRY}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in REGISTRY}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(
            f"create view {file.split('.')[0]} as select * from '{os.path.join(SF_DIR, file)}'"
        )
    return con


def _value(v):
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "null"
    if hasattr(v, "item"):
        v = v.item()
    return str(v)


def _table(df):
    cols = sorted(df.columns)
    rows = df[cols].astype(object).itertuples(index=False, name=None)
    return cols, sorted(tuple(map(_value, row)) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sql, name):
    got = _table(QUERIES[name](spark, SF_DIR).toPandas())
    want = _table(sql.sql(ORACLES[name]).df())
    assert got == want


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
