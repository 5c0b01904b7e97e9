"""Driver contract and oracle agreement at sf0.001 for every query that has
oracle SQL (same comparison the driver runs at sf0.01)."""

import math
from decimal import Decimal

import duckdb
import pytest

from conftest import SF001
import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_segment" in df.columns


def test_contract_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if isinstance(v, Decimal):
        return round(float(v), 9)
    return v


def _rows(recs, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in recs), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_agreement(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    srecs = [r.asDict() for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drecs = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    assert _rows(srecs, cols) == _rows(drecs, cols)
