"""Queries that SQL can express, against DuckDB."""

from pathlib import Path

import duckdb
import pytest

from linefit.llm import queries


@pytest.mark.parametrize("name", sorted(queries.TWINS))
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_twin(spark, name, folder):
    duck = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    df = queries.QUERIES[name](spark, folder)
    found = duck.execute(queries.TWINS[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    wanted = sorted((repr(r) for r in found.fetchall()))
    assert sorted(repr(tuple(r)) for r in df.select(*columns).collect()) == wanted


def test_registered():
    assert set(queries.TWINS) < set(queries.QUERIES)
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted([*(f"op{i}" for i in range(1, 14)), "pipeline"])
