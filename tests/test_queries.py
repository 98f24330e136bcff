"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tributary.queries.oracles import ORACLES
from tributary.queries.tables import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, database, name):
    result = entry_points.queries()[name](spark, FOLDER)
    expected = database.execute(entry_points.oracle_sql()[name])
    names = [column[0] for column in expected.description]
    assert sorted(result.columns) == sorted(names)
    order = [names.index(column) for column in result.columns]
    wanted = sorted((tuple(row[i] for i in order) for row in expected.fetchall()), key=repr)
    assert sorted(map(tuple, result.collect()), key=repr) == wanted


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5
