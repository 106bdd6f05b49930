"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from folio import queries

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_as_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, DATA)
    result = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    key = lambda rows: sorted([tuple(map(plain, r)) for r in rows], key=repr)
    assert key(tuple(r[c] for c in columns) for r in got.collect()) == key(result.fetchall())


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_runs(spark, name):
    assert queries.QUERIES[name](spark, DATA).count() > 0
