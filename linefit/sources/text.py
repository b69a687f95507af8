"""Plain text lines and the numbers in them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.functions import fields as X
from linefit.functions.once import computed_once

LINE = "value"
REASON = "reason"
EMPTY, WIDTH, BAD_NUMBER, NON_FINITE = "empty", "width", "bad_number", "non_finite"
REASONS = (EMPTY, WIDTH, BAD_NUMBER, NON_FINITE)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, in the string column ``value``. Large files are split among tasks."""
    return spark.read.text(path)


def with_reason(
    lines: DataFrame, numeric: Sequence[int], width: int | None = None, separator: str = ",",
    finite: bool = False,
) -> DataFrame:
    """Add ``numbers``, the fields at the positions ``numeric``, and ``reason``; a null reason
    marks a good line.

    NaN and infinite values are numbers; ``finite``, for lines to fit a model on, rejects them.

    ``width`` is the exact number of fields; None asks only that the numeric ones exist.
    """
    parts, numbers = F.col("fields"), F.col("numbers")
    needed = max(numeric) + 1
    if width is None:
        cut, wrong_width = X.split_fields(F.col(LINE), separator, needed), F.size(parts) < needed
    else:
        cut, wrong_width = X.split_fields(F.col(LINE), separator), F.size(parts) != width
    unreadable = reduce(or_, [F.get(numbers, F.lit(k)).isNull() for k in range(len(numeric))])
    bounded = reduce(and_, [F.get(numbers, F.lit(k)) * 0.0 == 0.0 for k in range(len(numeric))])
    split = computed_once(lines, {"fields": cut})
    read = {"numbers": F.array(*[X.to_double(X.field(parts, i)) for i in numeric])}
    return computed_once(split, read).withColumn(
        REASON,
        F.when(F.coalesce(F.trim(LINE) == "", F.lit(True)), EMPTY)
        .when(wrong_width, WIDTH)
        .when(unreadable, BAD_NUMBER)
        .when(F.lit(finite) & ~bounded, NON_FINITE),
    ).drop("fields")


def good_lines(
    lines: DataFrame, numeric: Sequence[int], width: int | None = None, separator: str = ",",
    finite: bool = False,
) -> DataFrame:
    """The good lines, with their ``numbers``."""
    checked = with_reason(lines, numeric, width, separator, finite)
    return checked.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_lines(
    lines: DataFrame, numeric: Sequence[int], width: int | None = None, separator: str = ",",
    finite: bool = False,
) -> DataFrame:
    """The lines :func:`good_lines` leaves out, with the reason."""
    checked = with_reason(lines, numeric, width, separator, finite)
    return checked.filter(F.col(REASON).isNotNull()).drop("numbers")
