"""Reproducible splits.

A row's side depends on its key (and the seed) alone, so the split is the same under any
partitioning, after a lost executor and on every re-read; ``DataFrame.randomSplit`` is not.
Rows with equal keys stay on one side: choose a key that tells rows apart where the shares
have to be kept (one line repeated for a third of the table moves as one block), or give no
key: then every row is drawn by itself, reproducibly only for the same files read in the same
splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32
DIGITS = 8
SIDE, FOLD = 1, DIGITS + 1  # where in the digest the digits for either purpose start


def key_digest(keys: Sequence[str], seed: int | str = 0) -> Column:
    """MD5 of ``seed:key|key…`` in hexadecimal; a null key counts as empty text."""
    text = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    separators = [F.lit(f"{seed}:"), *[F.lit("|")] * (len(keys) - 1)]
    return F.md5(F.concat(*[part for pair in zip(separators, text) for part in pair]))


def cut_points(weights: Sequence[float]) -> list[int]:
    """Upper hash bounds of all parts; the last one takes whatever rounding leaves."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    total = sum(weights)
    return [round(HASH_RANGE * w / total) for w in accumulate(weights)][:-1] + [HASH_RANGE]


def _below(digits: Column, bound: int) -> Column:
    """Hexadecimal digits compare as text in the order of the numbers they stand for."""
    return F.lit(True) if bound == HASH_RANGE else digits < F.lit(f"{bound:0{DIGITS}x}")


def _part(digits: Column, weights: Sequence[float]) -> Column:
    bounds = cut_points(weights)
    part = F.lit(len(bounds) - 1)
    for number, bound in reversed(list(enumerate(bounds[:-1]))):
        part = F.when(_below(digits, bound), number).otherwise(part)
    return part


def with_part(
    df: DataFrame, weights: Sequence[float], keys: Sequence[str] | None, seed: int = 0,
    name: str = "part",
) -> DataFrame:
    """Add the number of the part each row belongs to, for use in one pass over all parts."""
    if keys is None:
        passed = [(F.rand(seed) * HASH_RANGE >= b).cast("int") for b in cut_points(weights)[:-1]]
        return df.withColumn(name, reduce(add, passed, F.lit(0)))  # all draws of a row are one
    return df.withColumn(name, _part(key_digest(keys, seed), weights))


def hash_split(
    df: DataFrame, weights: Sequence[float], keys: Sequence[str] | None, seed: int = 0
) -> list[DataFrame]:
    """The parts as separate tables."""
    numbered = with_part(df, weights, keys, seed, "_part")
    return [numbered.filter(F.col("_part") == i).drop("_part") for i in range(len(weights))]


def fold_number(keys: Sequence[str] | None, folds: int, seed: int = 0) -> Column:
    """Cross-validation fold, from other digits of the same digest as the part."""
    if keys is None:
        return F.floor(F.rand(seed + FOLD) * folds).cast("int")
    return _part(F.substring(key_digest(keys, seed), FOLD, DIGITS), [1] * folds)
