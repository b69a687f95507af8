"""Counts, ranges and sums. All are partial-then-final aggregates: a hot key is combined
inside every task before anything is shuffled."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linefit.functions import vectors as V

HELD = 4096  # keys whose sums a task holds at most


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("count"))


def row_count_between(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows whose value lies in ``[low, high]``."""
    return row_count(df.filter(F.col(column).between(low, high)))


def min_max_avg(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("avg"))


def count_per_key(df: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Rows per key, over the rows that pass ``where``; the order is not defined."""
    kept = df if where is None else df.filter(where)
    return kept.groupBy(key).agg(F.count("*").alias("count"))


def count_per_key_ordered(df: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    return count_per_key(df, key, where).orderBy(key)


def minimum(df: DataFrame, column: str) -> Column:
    """The smallest value as a scalar subquery: usable in a later projection without a join
    and without a trip to the driver."""
    return df.agg(F.min(column)).scalar()


def squared_error_sum(df: DataFrame, label: str, prediction: str) -> DataFrame:
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sum(error * error).alias("squared_error_sum"))


def vector_sum(
    df: DataFrame, vector: str, by: Sequence[str] = (), width: int | None = None
) -> DataFrame:
    """Element-wise sum as rows ``(*by, idx, value)``.

    Unequal widths within a group, or another width than the known one (given, or in the
    column's metadata), are an error; null vectors are left out, and a group of nothing else
    has no rows. Short vectors of known width are summed position by position and only the
    sums become rows. Longer ones of known width are added up as blocks (:func:`_dense_sums`).
    Otherwise the elements become rows and are summed per position; the partial sums of a task
    number (groups × width) whatever the number of vectors.
    """
    width = width or V.known_width(df, vector)
    v = V.checked(F.col(vector), width)
    if width is not None and width <= V.WRITTEN_OUT:
        sums = [F.sum(V.element(v, j)) for j in range(width)]
        summed = df.groupBy(*by).agg(F.count(v).alias("_rows"), F.array(*sums).alias("_sums"))
        rows = summed.filter(F.col("_rows") > 0)
        return rows.select(*by, F.posexplode("_sums").alias("idx", "value"))
    if width is not None:
        return _dense_sums(df, vector, list(by), width)
    size = F.col("_size")
    unequal = F.raise_error(
        F.concat(F.lit("vector widths differ: "), F.min(size), F.lit(" and "), F.max(size))
    )
    return (
        df.select(*by, F.size(vector).alias("_size"), F.posexplode(v).alias("idx", "element"))
        .groupBy(*by, "idx")
        .agg(F.when(F.min(size) == F.max(size), F.sum("element")).otherwise(unequal).alias("value"))
    )


def _dense_sums(df: DataFrame, vector: str, by: list[str], width: int) -> DataFrame:
    """Each task adds its vectors up by key in numpy, a batch as one matrix, and passes its sums on
    whenever it holds ``HELD`` keys; only those become rows, which are added as any others."""
    rows = df.select(*by, V.as_array(df, vector).alias("_vector"))
    schema = T.StructType([*(rows.schema[c] for c in by), T.StructField("_sums", T.ArrayType(T.DoubleType()))])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def passed_on() -> pa.RecordBatch:
            keys = list(zip(*held)) if held and by else [[] for _ in by]
            arrays = [pa.array(k, t) for k, t in zip(keys, kinds)]
            return pa.RecordBatch.from_arrays(
                [*arrays, pa.array(list(held.values()), pa.list_(pa.float64()))], [*by, "_sums"]
            )

        kinds: list = []
        for batch in batches:
            kinds = [batch.column(i).type for i in range(len(by))]
            sizes = batch.column(len(by)).value_lengths()
            there = np.flatnonzero(sizes.is_valid().to_numpy(zero_copy_only=False))
            odd = next((n for n in sizes.drop_null().to_pylist() if n != width), None)
            if odd is not None:
                raise ValueError(f"vector widths differ: {odd} and {width}")
            if not len(there):
                continue
            vectors = batch.column(len(by)).drop_null().flatten()
            matrix = pc.fill_null(vectors, 0.0).to_numpy(zero_copy_only=False).reshape(-1, width)
            code = np.zeros(len(there), np.int64)
            for i in range(len(by)):
                own = batch.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)[there]
                _, code = np.unique(np.stack([code, own]), axis=1, return_inverse=True)
                code = code.reshape(-1)
            order = np.argsort(code, kind="stable")
            firsts = np.flatnonzero(np.diff(code[order], prepend=-1))
            sums = np.add.reduceat(matrix[order], firsts)
            for row, total in zip(there[order[firsts]].tolist(), sums):
                key = tuple(batch.column(i)[row].as_py() for i in range(len(by)))
                held[key] = held[key] + total if key in held else total
            if len(held) > HELD:
                yield passed_on()
                held.clear()
        if held:
            yield passed_on()

    elements = rows.mapInArrow(partial, schema).select(*by, F.posexplode("_sums").alias("idx", "element"))
    return elements.groupBy(*by, "idx").agg(F.sum("element").alias("value"))


def widths(df: DataFrame, vector: str) -> DataFrame:
    """Rows per vector width."""
    return df.groupBy(F.size(vector).alias("width")).agg(F.count("*").alias("count"))


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in a stated order: each task keeps its own best ``n``."""
    if not order:
        raise ValueError("a preview needs sort keys, or its rows are not defined")
    return df.orderBy(*order).limit(n)
