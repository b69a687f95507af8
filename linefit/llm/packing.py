"""Packing token sequences into windows by minimum bin slack.

Every document is cut into full windows and one remainder. How many pieces there are of each
length is all that matters for a good packing, and that table has at most ``window`` rows
however many documents there are. The bins are planned from it: the longest piece left opens a
bin, and a subset-sum over the bits of an integer finds the multiset of remaining lengths that
fills it closest to the brim; the plan repeats such a pattern as often as the counts allow.
Pieces then find their place by their rank among the pieces of their length.

Null text counts as empty (its end id alone). Repeated rows are packed as often as they occur.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linefit.llm.common import pieces_of, staged
from linefit.llm.tokens import DEFAULT, word_encoder

WINDOW, END_ID = 4096, 2
#: Pieces of one length are ranked in so many parts, which no hot length can outgrow much.
PARTS = 512


def token_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = DEFAULT,
    end_id: int = END_ID, window: int = WINDOW, with_ids: bool = False,
) -> DataFrame:
    """The pieces of every document: key, start, length, ids_crc32, doc_tokens (and ids)."""
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    rows = docs.select(key, F.coalesce(text, F.lit("")).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in pieces_of(batches, "text"):
            source, start, length, crc, total, parts = [], [], [], [], [], []
            for i, found in enumerate(encoder.encode(batch.column("text").to_pylist())):
                ids = np.frombuffer(found, encoder.dtype).astype("<u4").tobytes() + end
                n = len(ids) // 4
                for s in range(0, n, window):
                    part = ids[4 * s : 4 * (s + window)]
                    source.append(i)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        parts.append(part)
            columns = [batch.column(key).take(pa.array(source, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (start, length, crc, total)]
            names = [key, "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(parts, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(cut, schema + (", ids binary" if with_ids else ""))


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths with the largest sum of at most ``room``, as length → count.

    Bit s of an integer says that the sum s can be reached. Lengths join from the longest on,
    each in powers of two of its count, until the room can be filled to the brim.
    """
    reach, steps, brim, mask = 1, [], 1 << room, (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left:
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
            if reach & brim:
                break
        if reach & brim:
            break
    at, chosen = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """Bins as (pattern of length → count, repetitions); every piece is used exactly once."""
    left = {length: n for length, n in counts.items() if n}
    bins = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        pattern = fullest({x: n for x, n in rest.items() if n}, window - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[length] // n for length, n in pattern.items())
        for length, n in pattern.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        bins.append((pattern, times))
    return bins


def slots(bins: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """The plan as rows (length, first rank, count in a bin, first bin, offset), sorted."""
    rows, used, first_bin = [], {}, 0
    for pattern, times in bins:
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((length, used.get(length, 0), n, first_bin, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        first_bin += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """``pieces`` (as ``token_pieces`` gives them, written down) with sequence_id and offset."""
    dealt = pieces.withColumn(
        "_part", F.pmod(F.xxhash64(key, "start", "ids_crc32"), F.lit(PARTS)).cast("int")
    )
    counted = dealt.groupBy("length", "_part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(counts, window))
    ordered = W.partitionBy("length").orderBy("_part")
    bases = counted.select(
        "length", "_part", (F.sum("n").over(ordered) - F.col("n")).alias("_base")
    )
    within = W.partitionBy("length", "_part").orderBy(key, "start", "ids_crc32")
    ranked = dealt.withColumn("_rank", F.row_number().over(within) - 1).join(
        bases.hint("merge"), ["length", "_part"]
    )
    names = [c for c in pieces.columns]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks = table[:, 0], table[:, 1]
        order = lengths << 40 | ranks
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = sum(
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                for c in ("_base", "_rank")
            )
            row = table[np.searchsorted(order, length << 40 | rank, side="right") - 1]
            nth, slot = np.divmod(rank - row[:, 1], row[:, 2])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names]
                + [pa.array(row[:, 3] + nth), pa.array(row[:, 4] + slot * length)],
                [*names, "sequence_id", "offset"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """sequence_id and ids of each packed window, from pieces that carry their ids.

    A sequence is padded to ``window`` unless its length is a power of two.
    """

    def build(group: pa.Table) -> pa.Table:
        rows = group.sort_by("offset")
        ids = np.frombuffer(b"".join(rows.column("ids").to_pylist()), "<u4")
        if len(ids) & (len(ids) - 1):
            ids = np.concatenate([ids, np.full(window - len(ids), pad, "<u4")])
        return pa.table([rows.column("sequence_id")[:1], pa.array([ids.tobytes()], pa.binary())],
                        names=["sequence_id", "ids"])

    return packed.select("sequence_id", "offset", "ids").groupBy("sequence_id").applyInArrow(
        build, "sequence_id long, ids binary"
    )


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = DEFAULT,
    end_id: int = END_ID, window: int = WINDOW,
) -> DataFrame:
    """Tokenise, cut and pack ``docs``; texts are encoded once and only their pieces are kept."""
    pieces, _ = staged(token_pieces(docs, key, text, tokenizer, end_id, window), "pieces")
    return pack(pieces, key, window)
