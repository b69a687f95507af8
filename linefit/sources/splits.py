"""Lines of text files with what lies before them in their file.

Spark cuts a file into splits, and a task sees the lines of a split in order but nothing before
them. One aggregate measures all splits (bytes, quotes); sums over the splits of a file then tell
where each one starts and in which state. Both are the same however the file is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE, OFFSET = "file", "offset"


def raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block): lines between line feeds, in the order of the file within a split
    that starts at the byte ``block``. ``file`` is the path below ``path``, if it begins with it."""
    whole = F.col("_metadata.file_path")
    at = F.instr(whole, F.lit(path))
    return spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.when(at > 0, F.substr(whole, at + len(path))).otherwise(whole).alias(FILE),
        F.col("_metadata.file_block_start").alias("block"),
    )


def starts(lines: DataFrame, **measures: Column) -> DataFrame:
    """(file, block, …): for each split the sums of the measures over the splits before it."""
    summed = lines.groupBy(FILE, "block").agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    before = f"OVER (PARTITION BY {FILE} ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return summed.select(
        FILE, "block", *[F.expr(f"coalesce(sum({n}) {before}, 0L)").alias(n) for n in measures]
    )


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``local``, the bytes of the split's lines before each one."""
    last, before = None, 0
    for batch in batches:
        file, block = batch.column(FILE), batch.column("block")
        sizes = batch.column("size").to_numpy()
        local = np.zeros(len(sizes), np.int64)
        for start, end, key in runs_of(file, block):
            if key != last:
                last, before = key, 0
            own = np.cumsum(sizes[start:end])
            local[start:end] = before + own - sizes[start:end]
            before += int(own[-1])
        yield pa.RecordBatch.from_arrays([batch.column("value"), file, block, pa.array(local)],
                                         ["value", FILE, "block", "local"])


def runs_of(file: pa.Array, block: pa.Array) -> Iterator[tuple[int, int, tuple[str, int]]]:
    """(start, end, (file, block)) of the stretches of rows of one split."""
    if not len(block):
        return
    codes = file.dictionary_encode().indices.to_numpy()
    numbers = block.to_numpy()
    edges = np.flatnonzero((codes[1:] != codes[:-1]) | (numbers[1:] != numbers[:-1])) + 1
    for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)]):
        yield start, end, (file[start].as_py(), int(numbers[start]))


def addressed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, offset): every line with the byte at which it starts in its file.

    The address tells equal lines apart and is the same under any size of splits, so it is a key
    for splits and folds that draws every line by itself.
    """
    lines = raw_lines(spark, path)
    size = F.octet_length("value").cast("long") + 1
    begin = starts(lines, begin=size)
    local = lines.withColumn("size", size).mapInArrow(_running, f"value string, {FILE} string, block long, local long")
    return local.join(begin, [FILE, "block"]).select(
        F.rtrim("value", F.lit("\r")).alias("value"), FILE, (F.col("begin") + F.col("local")).alias(OFFSET)
    )


def addressed_rows(df: DataFrame) -> DataFrame:
    """A table read from Parquet files with ``file`` (its name) and ``offset`` (number of the row
    in it): a key for splits that draws every row by itself, whatever the size of splits."""
    return df.select(
        "*", F.col("_metadata.file_name").alias(FILE), F.col("_metadata.row_index").alias(OFFSET)
    )
