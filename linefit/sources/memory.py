"""Rows given by the caller, and named views."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small collection of the caller's as a distributed table, for parameters and results."""
    return spark.createDataFrame(list(rows), schema)


def unique_view(df: DataFrame, name: str) -> str:
    """Register ``df`` under a name that begins with ``name`` and is nobody else's."""
    own = f"{name}_{uuid.uuid4().hex}"
    register_view(df, own)
    return own


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` queryable by name in this session's SQL."""
    df.createOrReplaceTempView(name)
    return df
