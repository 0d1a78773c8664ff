"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(file)[: -len(".parquet")]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, database, name):
    expected = database.sql(entry.oracle_sql()[name])
    columns = sorted(expected.columns)
    got = entry.queries()[name](spark, SF_DIR)
    assert sorted(got.columns) == columns
    order = [expected.columns.index(c) for c in columns]
    left = sorted((tuple(r) for r in got.select(*columns).collect()), key=repr)
    right = sorted((tuple(r[i] for i in order) for r in expected.fetchall()), key=repr)
    assert left == right


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.columns[:2] == ["ticker", "trade_date"] and flagship.count() > 0
