"""Regression error of scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rmse_column(label: str = "label", prediction: str = "prediction") -> Column:
    """Aggregate expression for the root of the mean squared error (over n)."""
    error = F.col(label) - F.col(prediction)
    return F.sqrt(F.avg(error * error))


def rmse_table(
    scored: DataFrame, label: str = "label", prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows ``(*by, metric, value)``; with ``by``, train and test come from one pass."""
    value = rmse_column(label, prediction).alias("value")
    return scored.groupBy(*by).agg(value).select(*by, F.lit("rmse").alias("metric"), "value")


def rmse(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return scored.agg(rmse_column(label, prediction)).first()[0]
