"""Every registered query of the engine against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from sparkloom.plans import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for name in os.listdir(DATA):
        db.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return db


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([plain(r[i]) for i in order]) for r in found)


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, duck, name):
    registered = queries.REGISTRY[name]
    df = registered.run(spark, DATA)
    found = rows(df.columns, df.collect())
    if registered.sql is None:
        assert found and len(df.columns) == len(set(df.columns))
        return
    want = duck.sql(registered.sql)
    assert sorted(df.columns) == sorted(want.columns)
    assert found == rows(want.columns, want.fetchall())


def test_flagship(spark):
    assert queries.flagship(spark, DATA).count() > 0
