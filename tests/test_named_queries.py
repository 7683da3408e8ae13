"""Every named query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from check import TABLES, compare
from oracle import ORACLE
from shelfstream.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    verdict, _ = compare(spark, con, name, SF_DIR)
    assert verdict.startswith("ok") and verdict != "ok (0)", verdict


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
