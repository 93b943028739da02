"""Every registered query that has a SQL check agrees with it on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from boxframe.plans.fixtures import NUMBERED, TABLES, Inputs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def comparable(rows):
    def text(value):
        return "~" if value is None or value != value else repr(value + 0.0) if isinstance(value, float) else str(value)

    return sorted(tuple(text(v) for v in row) for row in rows)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 19


def test_registry():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_against_sql(spark, database, name):
    result = entry_points.queries()[name](spark, FOLDER)
    columns = sorted(result.columns)
    mine = [tuple(r[c] for c in columns) for r in result.collect()]
    cursor = database.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = [tuple(row[i] for i in order) for row in cursor.fetchall()]
    assert comparable(mine) == comparable(theirs)


@pytest.mark.parametrize("name", sorted(NUMBERED))
def test_numbering_of_large_keys(spark, name):
    inputs = Inputs(spark, FOLDER)
    usual, cut = inputs.view(name), inputs.view(name, hot_rows=4)
    assert usual.exceptAll(cut).count() == 0 and cut.exceptAll(usual).count() == 0
