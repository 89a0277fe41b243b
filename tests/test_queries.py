"""Queries of the catalog against their SQL at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tools.check import TABLES, rows_of

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(E.queries()))
def test_query(spark, con, name):
    df = E.queries()[name](spark, SF)
    got, cols = rows_of(df.columns, [tuple(r) for r in df.collect()])
    text = E.oracle_sql().get(name)
    if text is None:
        assert got
        return
    res = con.execute(text)
    want, names = rows_of([d[0] for d in res.description], res.fetchall())
    assert cols == names
    assert got == want


def test_entry(spark):
    assert E.entry(spark).count() == len(E.queries()[E.FLAGSHIP](spark, E.SMOKE_DIR).collect())
