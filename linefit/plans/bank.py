"""Customer lines of a bank: quoted text between semicolons, ages counted."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.functions import fields as X
from linefit.functions.once import computed_once
from linefit.operators import summary
from linefit.plans import fixed_values as K
from linefit.sources import delimited, text
from linefit.sources.memory import unique_view

# Field 4 is not used.
POSITIONS = {"age": 0, "job": 1, "marital": 2, "education": 3, "balance": 5}
NUMBERS = ("age", "balance")


def read_bank(spark: SparkSession, path: str, reader=delimited) -> DataFrame:
    """Typed customers; a delimiter inside quotes belongs to its field, and so does a line break
    if ``reader`` is :mod:`linefit.sources.multiline`.

    The file may have more columns than are used: they are addressed by position.
    """
    return customers(reader.read_delimited(spark, path, header=True, separator=";"))


def customers(records: DataFrame) -> DataFrame:
    """Records of texts as typed customers."""
    names = records.columns
    return records.select(
        *[
            (X.to_integer(F.col(names[p])) if n in NUMBERS else F.col(names[p])).alias(n)
            for n, p in POSITIONS.items()
        ]
    )


def rejected_records(spark: SparkSession, path: str, reader=delimited) -> DataFrame:
    """``(reason, count)``: malformed records, and those whose age or balance is no integer.

    :func:`read_bank` drops the former and keeps the latter with a null.
    """
    checked = reader.checked_records(spark, path, header=True, separator=";")
    names = checked.columns
    bad = reduce(or_, [X.to_integer(F.col(names[POSITIONS[n]])).isNull() for n in NUMBERS])
    reason = F.when(F.col(delimited.CORRUPT).isNotNull(), text.WIDTH).when(bad, text.BAD_NUMBER)
    return (
        checked.filter(delimited.parsed(checked)).groupBy(reason.alias(text.REASON))
        .agg(F.count("*").alias("count")).filter(F.col(text.REASON).isNotNull())
    )


def with_reason(lines: DataFrame) -> DataFrame:
    """Bare lines but the header, with typed fields and ``reason`` (null for a good line).

    A good line has the fields that are used, and integers where those are numbers.
    """
    parts = computed_once(lines, {"fields": X.split_fields(F.col("value"), ";")})
    fields = F.col("fields")
    first = X.strip_quotes(X.field(fields, 0))
    body = parts.filter(F.coalesce(first != "age", F.lit(True)))
    columns = {n: X.strip_quotes(X.field(fields, p)) for n, p in POSITIONS.items()}
    typed = {n: X.to_integer(c) if n in NUMBERS else c for n, c in columns.items()}
    reason = (
        F.when(F.coalesce(F.trim("value") == "", F.lit(True)), text.EMPTY)
        .when(F.size(fields) <= max(POSITIONS.values()), text.WIDTH)
        .when(reduce(or_, [typed[n].isNull() for n in NUMBERS]), text.BAD_NUMBER)
    )
    return body.select(*[c.alias(n) for n, c in typed.items()], reason.alias(text.REASON))


def bank_from_lines(lines: DataFrame) -> DataFrame:
    """The customers of good lines, for text known to hold no delimiter inside quotes."""
    return with_reason(lines).filter(F.col(text.REASON).isNull()).drop(text.REASON)


def customers_per_age(bank: DataFrame, bound: int = K.AGE_BOUND) -> DataFrame:
    return summary.count_per_key_ordered(bank, "age", F.col("age") < bound)


def customers_per_age_sql(
    spark: SparkSession, bank: DataFrame, bound: int = K.AGE_BOUND
) -> DataFrame:
    view = unique_view(bank, "bank")
    return spark.sql(
        f"SELECT age, count(1) AS count FROM {view} WHERE age < {bound} "
        "GROUP BY age ORDER BY age"
    )
