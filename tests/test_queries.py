"""Every registered query against its SQL on the smallest sample tables."""

from pathlib import Path

import duckdb
import pytest
from compare import compare

from __spark_entry__ import entry, oracle_sql, queries
from screenlake.catalog import ORACLES, QUERIES

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="sample tables not found")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, note = compare(spark, con, name, str(SF_DIR))
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(queries()) >= set(QUERIES) and set(oracle_sql()) >= set(ORACLES)


def test_entry(spark):
    assert entry(spark).count() == 100
