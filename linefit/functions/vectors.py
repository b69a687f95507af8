"""Arithmetic on ``array<double>`` columns, without Python on the executors.

Two forms are used. Short vectors of known width are written out element by element, which
Catalyst folds into the expressions that built the array. Longer ones use the array
functions, whose plan does not grow with the width (at width 64 they also ran three times
as fast as the written-out form).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add as plus

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WRITTEN_OUT = 16
WIDTH_KEY = "width"


def as_array(df: DataFrame, name: str) -> Column:
    """Column ``name`` as ``array<double>``, whether it holds arrays or ML vectors."""
    kind = df.schema[name].dataType
    if isinstance(kind, VectorUDT):
        return vector_to_array(F.col(name))
    if kind == T.ArrayType(T.DoubleType(), True) or kind == T.ArrayType(T.DoubleType(), False):
        return F.col(name)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        return F.col(name).cast("array<double>")
    raise TypeError(f"column {name!r} holds {kind.simpleString()}, not a numeric vector")


def known_width(df: DataFrame, name: str) -> int | None:
    """Vector width carried in the column's metadata, or None."""
    metadata = df.schema[name].metadata or {}
    if WIDTH_KEY in metadata:
        return int(metadata[WIDTH_KEY])
    attributes = metadata.get("ml_attr", {})
    return int(attributes["num_attrs"]) if "num_attrs" in attributes else None


def width_metadata(width: int) -> dict:
    """Metadata that tells later stages, MLlib's included, how wide a vector column is."""
    return {WIDTH_KEY: width, "ml_attr": {"num_attrs": width}}


def element(vector: Column, position: int) -> Column:
    return F.get(vector, F.lit(position))


def pick(vector: Column, positions: Sequence[int]) -> Column:
    """The elements at ``positions``, in that order."""
    return F.array(*[element(vector, p) for p in positions])


def same_width(a: Column, b: Column, result: Column) -> Column:
    """``result`` where both vectors are equally wide, an error where they are not."""
    message = F.concat(
        F.lit("vector widths differ: "), F.size(a).cast("string"), F.lit(" and "),
        F.size(b).cast("string"),
    )
    return F.when(F.size(a) == F.size(b), result).when(
        a.isNotNull() & b.isNotNull(), F.raise_error(message)
    )


def checked(vector: Column, width: int | None) -> Column:
    """``vector`` where it is ``width`` wide (or null), an error where it is not."""
    if width is None:
        return vector
    message = F.concat(
        F.lit("vector widths differ: "), F.size(vector).cast("string"), F.lit(f" and {width}")
    )
    return F.when(F.size(vector) == width, vector).when(
        vector.isNotNull(), F.raise_error(message)
    )


def literal(values: Sequence[float]) -> Column:
    """A vector of constants; a plan holds one text however many there are."""
    if len(values) <= WRITTEN_OUT:
        return F.lit([float(v) for v in values])
    return F.split(F.lit(" ".join(map(repr, map(float, values)))), " ").cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    """Dot product of two vector columns; unequal widths are an error."""
    products = F.zip_with(a, b, lambda x, y: x * y)
    return same_width(a, b, F.aggregate(products, F.lit(0.0), lambda s, x: s + x))


def dot_weights(vector: Column, weights: Sequence[float], check_width: bool = True) -> Column:
    """Dot product with fixed weights.

    ``check_width=False`` is for vectors whose width is already known to be right.
    """
    values = [float(w) for w in weights]
    if len(values) > WRITTEN_OUT:
        result = F.aggregate(
            F.zip_with(vector, literal(values), lambda x, w: x * w),
            F.lit(0.0),
            lambda s, x: s + x,
        )
    else:
        result = reduce(plus, [element(vector, j) * F.lit(w) for j, w in enumerate(values)])
    return same_width(vector, literal(values), result) if check_width else result


def scale(vector: Column, factor: Column | float) -> Column:
    by = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.transform(vector, lambda x: x * by)


def add(a: Column, b: Column) -> Column:
    """Element-wise sum; unequal widths are an error."""
    return same_width(a, b, F.zip_with(a, b, lambda x, y: x + y))


def fill(width: Column | int, value: float) -> Column:
    """Vector of ``width`` equal elements."""
    return F.array_repeat(F.lit(float(value)), width)


def degree_two(vector: Column, width: int | None = None) -> Column:
    """All terms of degree one and two, without the constant.

    The order is that of MLlib's expansion: for each element x_j first x_j itself, then its
    products with x_0 … x_j. A vector that is not ``width`` wide is an error and a null one
    gives null, whichever form is used.
    """
    if width is not None and width <= WRITTEN_OUT:
        xs = [element(vector, j) for j in range(width)]
        terms = [t for j, x in enumerate(xs) for t in (x, *(xs[i] * x for i in range(j + 1)))]
        return F.when(checked(vector, width).isNotNull(), F.array(*terms))
    vector = checked(vector, width)
    return F.flatten(
        F.transform(
            vector,
            lambda x, j: F.concat(
                F.array(x), F.transform(F.slice(vector, F.lit(1), j + 1), lambda y: y * x)
            ),
        )
    )


def degree_two_width(width: int) -> int:
    return width * (width + 3) // 2
