"""Which vectors take part in a search, and how they reach numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Not null, no null or non-finite component, and not zero."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def common_width(rows: DataFrame, vector: str) -> int | None:
    """The most frequent number of components (the smaller one of a tie)."""
    found = (
        rows.where(usable(vector)).groupBy(F.size(vector).alias("d")).count()
        .orderBy(F.desc("count"), "d").first()
    )
    return found["d"] if found else None


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, width)
