"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from wellspan.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.sql(f"create view {file.removesuffix('.parquet')} as select * from '{FOLDER}/{file}'")
    return con


def rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(map(repr, frame.where(frame.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    found = QUERIES[name](spark, FOLDER).toPandas()
    if name in ORACLES:
        assert rows(found) == rows(sql.sql(ORACLES[name]).df())
    else:
        assert len(found)


def test_entry(spark):
    assert entry.entry(spark).count()
    assert set(entry.oracle_sql()) <= set(entry.queries())
