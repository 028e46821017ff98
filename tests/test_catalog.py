"""Every query with SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from check import compare
from shoptrail.plans.catalog import QUERIES
from shoptrail.plans.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    ok, message, _, _ = compare(spark, db, name, FOLDER)
    assert ok, message
