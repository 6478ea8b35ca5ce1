"""Every registered query against its DuckDB oracle (the driver's check, at sf0.001)."""

import math

import duckdb
import pytest

from __spark_entry__ import QUERIES, entry, oracle_sql

from conftest import SF_SMALL

TABLES = ["events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(result, con, name):
    df = result(name)
    rows = df.collect()
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, rows) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0 and "rank" in df.columns
