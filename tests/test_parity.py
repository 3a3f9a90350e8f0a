"""Every registered query against its DuckDB twin on the smallest data set."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, float):
            return round(v, 9)
        return v

    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql())
    assert set(QUERIES) <= set(queries())
    assert len(QUERIES) >= 29


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, duck, name):
    df = queries()[name](spark, SF)
    cur = duck.execute(oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm(df.collect(), df.columns) == _norm(cur.fetchall(), dcols)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["value"] and df.count() > 0
