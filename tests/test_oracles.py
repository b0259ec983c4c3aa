"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same check at sf0.01)."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


def test_entry_smoke(spark):
    df = se.entry(spark)
    assert df.count() > 0 and "window_start" in df.columns


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = se.queries()[name](spark, SF)
    cols = sdf.columns
    srows = sorted((tuple(_norm(x) for x in r) for r in sdf.collect()), key=_key)
    sql = se.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no oracle")
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    assert sorted(dcols) == sorted(cols)
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=_key)
    assert len(srows) == len(drows)
    assert srows == drows


def test_every_query_has_an_oracle():
    from logweave.plans.catalog import QUERIES
    assert set(QUERIES) <= set(se.oracle_sql()) <= set(se.queries())
    assert len(QUERIES) >= 53
