"""Every registered query against its DuckDB oracle on the driver tables (sf0.001)."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from cardflow.registry.catalog import builders

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    # queries beyond the reports and operators of this library may have none
    assert set(builders()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = duck.execute(E.oracle_sql()[key])
    cols = [c[0] for c in rel.description]
    want = rel.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "appl_id" and df.count() > 0
