"""Expensive expressions, evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MARK = "_once"


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add ``columns`` so that later filters and functions use the computed values.

    Catalyst moves a filter below a projection by repeating the projected expressions inside
    the filter: splitting a line and reading its numbers would run once for every mention. It
    leaves a projection alone that has a non-deterministic column, so one is added here (the
    partition number, constant within a task) and used in an always true condition.

    No later filter passes this point: conditions on partition columns or on other columns a
    scan could use belong before the call.
    """
    marked = df.withColumns({**columns, _MARK: F.spark_partition_id()})
    return marked.filter(F.col(_MARK) >= 0).drop(_MARK)
