"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from gleanery.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def rows(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(r[i] for i in order) for r in data), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", catalogue.SQL)
def test_same_rows(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = db.sql(catalogue.SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 25
    assert set(e.oracle_sql()) <= set(e.queries())
