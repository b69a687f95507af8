"""Delimited files through Spark's CSV reader.

A malformed record is one with the wrong number of fields. The reader decides that on the
whole record (``columnPruning`` off), so the answer does not depend on which columns a query
goes on to use. Every field is read as text and converted later, which keeps "wrong number of
fields" apart from "not a number". ``multiLine`` stays off, so that one huge file is still
shared among tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _reader(
    spark: SparkSession, schema: T.StructType, mode: str, header: bool, separator: str
) -> DataFrameReader:
    reader = (
        spark.read.schema(schema)
        .option("sep", separator)
        .option("quote", '"')
        .option("mode", mode)
        .option("columnPruning", "false")
    )
    if header:
        # Names come from the caller, so a file with other columns must not pass unnoticed.
        reader = reader.option("header", "true").option("enforceSchema", "false")
    return reader


def column_names(
    spark: SparkSession, path: str, header: bool = True, separator: str = ","
) -> list[str]:
    """Names in the header line, or ``_c0`` … from the width of the first line."""
    return spark.read.csv(path, sep=separator, header=header, inferSchema=False).columns


def read_delimited(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    header: bool = True,
    separator: str = ",",
) -> DataFrame:
    """Records with the right number of fields, all columns text.

    Without ``columns`` the names are looked up in the first line of the file.
    """
    names = columns or column_names(spark, path, header, separator)
    return _reader(spark, text_schema(names), "DROPMALFORMED", header, separator).csv(path)


def rejected_records(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    header: bool = True,
    separator: str = ",",
) -> DataFrame:
    """The records :func:`read_delimited` drops, as raw text in ``record``."""
    rows = checked_records(spark, path, columns, header, separator)
    return rows.filter(F.col(CORRUPT).isNotNull() & parsed(rows)).select(
        F.col(CORRUPT).alias("record")
    )


def parsed(checked: DataFrame) -> Column:
    """Always true. Spark refuses queries on the raw record alone; this keeps a parsed column
    in the scan."""
    return F.coalesce(F.col(checked.columns[0]), F.lit("")) >= ""


def checked_records(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    header: bool = True,
    separator: str = ",",
) -> DataFrame:
    """All records; a malformed one has its raw text in the column ``CORRUPT``."""
    names = columns or column_names(spark, path, header, separator)
    schema = text_schema([*names, CORRUPT])
    # enforceSchema would compare the extra column with the header, so it stays on here.
    reader = _reader(spark, schema, "PERMISSIVE", header, separator)
    return (
        reader.option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", "true")
        .csv(path)
    )
