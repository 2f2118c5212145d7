import os

import duckdb
import pytest

import __spark_entry__ as entry
from skygauge.contract import all_check_sql, all_queries
from tools.compare import TABLES, compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_its_check():
    assert set(all_check_sql()) == set(all_queries())
    assert set(all_queries()) <= set(entry.queries()) and set(all_check_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_its_check(spark, db, name):
    line = compare(spark, db, name, all_queries()[name], all_check_sql().get(name), SF_DIR)
    assert line.startswith("ok") and "TYPES" not in line, line


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "weather_key" and df.count() > 0
