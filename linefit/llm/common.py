"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.sources.staging import new_path, remove_at_exit


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to the shared folder and read back, and its path."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    remove_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove staged tables that are no longer read. A Connect client leaves them in place."""
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def once_per_process(family: str, key: Any, make: Callable[[], Any]) -> Any:
    """The value for ``key`` in this Python worker, made at first use.

    A worker serves all queries of a session, one after the other. It keeps two values of one
    family at most, and none of other families, so that a long session does not fill it.
    """
    kept = sys.__dict__.setdefault("_kept_by_llm_tasks", {})
    for other in [f for f in kept if f != family]:
        del kept[other]
    values = kept.setdefault(family, {})
    if key not in values:
        if len(values) == 2:
            values.clear()
        values[key] = make()
    return values[key]


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Have the session pass rows to Python in batches of at most ``most`` bytes from now on.

    Spark's own limit is 64 MB, which each task holds several times over, in its JVM and worker.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name, "64m").lower().rstrip("b").replace("k", "000").replace("m", "000000").replace("g", "000000000")) > most:
        spark.conf.set(name, f"{most}b")


def named(name: str) -> Column:
    """The column of that very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_of(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The caller's columns in one column ``row``, so that no name of theirs meets one of ours."""
    names = df.columns if columns is None else columns
    return F.struct(*([named(c) for c in names] or [F.lit(0).alias("nothing")])).alias("row")


def unpacked(df: DataFrame, columns: list[str], replaced: dict[str, Column] | None = None) -> list[Column]:
    """The caller's columns out of ``row`` again, some of them replaced."""
    replaced = replaced or {}
    return [replaced[c].alias(c) if c in replaced else F.col("row").getField(c).alias(c) for c in columns]


def pieces_of(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator:
    """The batches again, cut so that ``column`` holds about ``most_bytes`` in each.

    A row that is larger by itself comes alone.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        first = total = 0
        for i, size in enumerate(sizes.to_pylist()):
            if total and total + size > most_bytes:
                yield batch.slice(first, i - first)
                first, total = i, 0
            total += size
        if first < batch.num_rows:
            yield batch.slice(first)


def salted_lookup(
    rows: DataFrame, key: str, mapping: DataFrame, spread: Column, salts: int = 16
) -> DataFrame:
    """Left join of ``rows`` with ``mapping`` (one row per key), safe for hot keys.

    Each key of ``rows`` is dealt over ``salts`` partitions by ``spread`` (a column that tells
    rows apart), and ``mapping`` is repeated as often, so no partition gets more than a
    ``salts``-th of a key's rows.
    """
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    right = mapping.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"], "left").drop("_salt")
