"""Every registered query against its SQL twin."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from linefit.plans import catalogue, catalogue_sql

QUERIES, TWINS = catalogue.QUERIES, catalogue_sql.twins()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def values(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_twin(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    rows = df.collect()
    assert rows
    answer = duck.execute(TWINS[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert values(df.columns, rows) == values(columns, answer.fetchall())


def test_every_query_has_a_twin_and_is_registered():
    assert set(TWINS) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(TWINS) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["series", "iter", "value"]
    assert df.count() == 102
