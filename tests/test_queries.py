"""Every registered query runs at the smallest scale, and equals its SQL where it has one."""

import duckdb
import pytest

import __spark_entry__ as entry_points

from .compare import difference

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    found = entry_points.entry(spark)
    assert found.columns == ["level", "month", "total"]
    assert found.count() == 60


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query(spark, duck, name):
    found = entry_points.queries()[name](spark, FOLDER).toPandas()
    assert len(found)
    sql = entry_points.oracle_sql().get(name)
    if sql is not None:
        assert difference(found, duck.execute(sql).df()) is None
