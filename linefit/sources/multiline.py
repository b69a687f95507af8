"""Delimited files whose quoted fields may hold line breaks, shared among tasks.

Whether a line begins a record depends on the number of quotes before it in the file: inside
quotes it is odd. One aggregate counts the quotes of every split, their sums give the state in
which each split starts, and every task puts the records of its splits together from the true
state. A record that runs over splits is put together from its pieces. Spark's ``multiLine`` reads
a file in one task instead.

Quotes within a field are doubled, as RFC 4180 has it, so every quote changes the state. A field
that is never closed would swallow the rest of its file: a record longer than ``LONGEST`` bytes ends
the job with an error that names the file.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.sources.delimited import CORRUPT, text_schema
from linefit.sources.splits import FILE, raw_lines, runs_of, starts

LONGEST = 16 << 20
WHOLE, TAIL, OPEN = 0, 1, 2


def _assembler(odd: frozenset[tuple[str, int]], longest: int):
    """Lines into (file, block, nth, kind, record): whole records, and pieces of others.

    A ``TAIL`` is what a split holds of a record begun before; ``OPEN`` is a record begun here
    and not ended. ``nth`` counts a split's records.
    """

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, held, size, nth, kind = None, 0, [], 0, 0, WHOLE

        def batch_of(rows):
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            columns = list(zip(*rows)) or [[]] * 5
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [FILE, "block", "nth", "kind", "record"]
            )

        for batch in batches:
            values, rows = batch.column("value"), []
            quotes = pc.count_substring(values, '"').to_numpy()
            for start, end, key in runs_of(batch.column(FILE), batch.column("block")):
                if key != split:
                    if held:
                        rows.append((*split, nth, kind, "\n".join(held)))
                    split, inside, held, size, nth = key, int(key in odd), [], 0, 0
                    kind = TAIL if inside else WHOLE
                after = (inside + np.cumsum(quotes[start:end])) % 2
                for text, state in zip(values.slice(start, end - start).to_pylist(), after.tolist()):
                    if not held and kind != TAIL and not state:
                        rows.append((*split, nth, WHOLE, text))
                        nth += 1
                        continue
                    if not held and kind != TAIL:
                        kind = OPEN
                    held.append(text)
                    size += len(text) + 1
                    if size > longest:
                        raise ValueError(f"a quote in {split[0]} is not closed within {longest} bytes")
                    if not state:
                        rows.append((*split, nth, TAIL if kind == TAIL else WHOLE, "\n".join(held)))
                        held, size, nth, kind = [], 0, nth + 1, WHOLE
                inside = int(after[-1])
            yield batch_of(rows)
        if held:
            yield batch_of([(*split, nth, kind, "\n".join(held))])

    return assembled


def read_records(spark: SparkSession, path: str, longest: int = LONGEST) -> DataFrame:
    """(file, block, nth, record) of every record; ``block`` and ``nth`` say where it begins, and
    the first record of a file has 0 and 0."""
    lines = raw_lines(spark, path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    state = starts(lines, quotes=quotes.cast("long")).where("quotes % 2 = 1")
    odd = frozenset((r[FILE], r["block"]) for r in state.collect())  # splits that start in a field
    schema = f"{FILE} string, block long, nth long, kind int, record string"
    found = lines.mapInArrow(_assembler(odd, longest), schema)
    if not odd:
        return found.drop("kind")
    begun = f"OVER (PARTITION BY {FILE} ORDER BY block, kind ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    pieces = found.where(f"kind <> {WHOLE}").select(
        "*", *[F.expr(f"last(CASE WHEN kind = {OPEN} THEN {c} END, true) {begun}").alias(f"of_{c}") for c in ("block", "nth")]
    )
    parts = F.sort_array(F.collect_list(F.struct("block", "kind", "record")))
    too_long = F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col(FILE)))
    joined = pieces.groupBy(FILE, "of_block", "of_nth").agg(parts.alias("parts"), F.sum(F.length("record")).alias("size")).select(
        FILE, F.col("of_block").alias("block"), F.col("of_nth").alias("nth"),
        F.when(F.col("size") <= longest, F.array_join("parts.record", "\n")).otherwise(too_long).alias("record"),
    )
    return found.where(f"kind = {WHOLE}").drop("kind").unionByName(joined)


def _first(records: DataFrame):
    return (F.col("block") == 0) & (F.col("nth") == 0)


def column_names(spark: SparkSession, path: str, separator: str = ",") -> list[str]:
    """Names in the first record."""
    records = read_records(spark, path)
    row = records.where(_first(records)).select(F.rtrim("record", F.lit("\r")).alias("record")).first()
    if row is None:
        raise ValueError(f"no header in {path}")
    return next(csv.reader(io.StringIO(row["record"], newline=""), delimiter=separator))


def _options(separator: str) -> dict[str, str]:
    return {"sep": separator, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def checked_records(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, header: bool = True, separator: str = ",",
) -> DataFrame:
    """All records, every column text; one with the wrong number of fields has its raw text in
    ``delimited.CORRUPT``. Blank lines between records are no records, as with Spark's reader."""
    names = columns or column_names(spark, path, separator)
    records = read_records(spark, path)
    if header:
        records = records.where(~_first(records))
    text = F.rtrim("record", F.lit("\r"))
    schema = ", ".join(f"`{f.name}` string" for f in text_schema([*names, CORRUPT]))
    rows = records.where(F.trim("record") != "").select(F.from_csv(text, schema, _options(separator)).alias("row"))
    return rows.select("row.*")


def read_delimited(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, header: bool = True, separator: str = ",",
) -> DataFrame:
    """Records with the right number of fields, all columns text."""
    return checked_records(spark, path, columns, header, separator).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_records(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, header: bool = True, separator: str = ",",
) -> DataFrame:
    """The records :func:`read_delimited` drops, as raw text in ``record``."""
    checked = checked_records(spark, path, columns, header, separator)
    return checked.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("record"))
