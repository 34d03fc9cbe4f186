"""Every registered query against its SQL twin, on the smallest test data."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from salesloom.catalog import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(pdf: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or (not hasattr(value, "__len__") and pd.isna(value)):
            return "NULL"
        return repr(float(value)) if isinstance(value, float) else str(value)
    return sorted(tuple(plain(v) for v in row) for row in pdf[sorted(pdf.columns)].itertuples(index=False))


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    expected = duck.execute(SQL[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_streamed_queries_leave_the_settings_alone(spark):
    before = dict(spark.conf.getAll)
    QUERIES["st01_sector_stream"](spark, FOLDER).count()
    assert dict(spark.conf.getAll) == before
