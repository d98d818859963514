"""Every registered query against its DuckDB oracle on the smallest test data:
same columns, same rows (order-insensitive, exact values)."""

import datetime as dt
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from starbeam.config import FIXTURE
from starbeam.plans import registry
from starbeam.sources.testdata import TABLES


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        v = pd.Timestamp(v)
        return v.date().isoformat() if v == v.normalize() else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, bool):
        return int(v)
    return v if isinstance(v, int) else str(v)


def _rows(df: pd.DataFrame):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False)),
                  key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


QUERIES = registry.all_queries(FIXTURE)
SQL = registry.all_oracle_sql(FIXTURE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf_small, duck, name):
    got = QUERIES[name](spark, sf_small).toPandas()
    want = duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "customer_segment" in df.columns
