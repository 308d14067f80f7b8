"""Every query against its SQL on the smallest tables, and the driver's contract."""

from __future__ import annotations

import math
import os

import pytest

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")

from quire.plans import catalog  # noqa: E402


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{DATA}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return round(float(v), 9) if isinstance(v, int) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, con, name):
    df = catalog.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(v) for v in r) for r in df.select(*cols).collect()), key=str)
    rel = con.sql(catalog.ORACLES[name])
    assert sorted(rel.columns) == cols
    want = sorted((tuple(plain(v) for v in r) for r in con.sql(f"select {', '.join(cols)} from ({catalog.ORACLES[name]})").fetchall()), key=str)
    assert got == want


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) and len(catalog.QUERIES) >= 40


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
