"""Every registered query against its SQL twin on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    rows = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        result = db.execute(ORACLES[name])
        columns = [d[0] for d in result.description]
        assert compare(rows, df.columns, result.fetchall(), columns) is None
    else:
        assert rows
