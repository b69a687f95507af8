"""BPE encoding by tree concatenation, and decoding.

A long text is cut into leaves that tasks encode in parallel. Neighbours are then joined pair
by pair: a window of the text around the join is encoded again and grows until it agrees with
the left side on one token and with the right side on another; the ids are the left side's up
to the first, the window's between them and the right side's from the second. A pair of
neighbouring tokens is valid BPE or not whatever stands around it, so agreement on a token at
the same place on each side makes the whole exact. Only the unsplit text around a join (to the
next white space on either side, which no token crosses) needs token offsets.

Null text counts as empty. Repeated rows give repeated results; extra columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.llm.common import pieces_of, small_batches
from linefit.llm.tokens import DEFAULT, load_tokenizer, word_encoder

#: Characters of a leaf. Shorter texts are trees of one leaf.
LEAF = 32_768
#: Characters at either end of a leaf that a join may look at before white space ends it, and
#: the least distance of an agreement from the join; longer than any special token.
EDGE, MARGIN = 64, 32
_SPACE = re.compile("[ \t\n\r]")


@dataclass
class Run:
    """A stretch of text with its tokens: ids and the characters each one covers."""

    text: str
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


@dataclass
class Node:
    """Encoded text: head, ids between, tail. An unsplit stretch is all head (``middle`` None)."""

    head: Run
    middle: list[bytes] | None
    tail: Run | None


def run_of(tokenizer, text: str) -> Run:
    encoding = tokenizer.encode(text, add_special_tokens=False)
    spans = np.array(encoding.offsets, np.int64).reshape(-1, 2)
    return Run(text, np.array(encoding.ids, np.uint32), spans[:, 0], spans[:, 1])


def leaf_of(tokenizer, encode, text: str) -> Node:
    """``encode`` gives the ids of a text as bytes of unsigned 32-bit integers."""
    first = _SPACE.search(text, EDGE)
    last = max(text.rfind(c, 0, max(0, len(text) - EDGE)) for c in " \t\n\r")
    if first is None or last <= first.start():
        return Node(run_of(tokenizer, text), None, None)
    start = first.start()
    return Node(
        run_of(tokenizer, text[:start]), [encode(text[start:last])], run_of(tokenizer, text[last:])
    )


def join_runs(tokenizer, left: Run, right: Run) -> Run:
    """Both stretches as one, from windows around the join that grow until all agree."""
    cut = len(left.text)
    text = left.text + right.text
    r_starts, r_ends = right.starts + cut, right.ends + cut
    reach = 2 * EDGE
    while True:
        begins = left.starts[left.starts <= cut - reach]
        low = int(begins[-1]) if len(begins) else 0
        stops = r_ends[r_ends >= cut + reach]
        high = int(stops[0]) if len(stops) else len(text)
        window = run_of(tokenizer, text[low:high])
        starts, ends = window.starts + low, window.ends + low
        a = _agree(left.ids, left.starts, left.ends, window.ids, starts, ends,
                   low, cut - MARGIN) if low else (0, 0)
        b = _agree(right.ids, r_starts, r_ends, window.ids, starts, ends,
                   cut + MARGIN, high) if high < len(text) else (len(right.ids), len(window.ids))
        if a is not None and b is not None:
            keep = slice(a[1], b[1])
            return Run(
                text,
                np.concatenate([left.ids[: a[0]], window.ids[keep], right.ids[b[0] :]]),
                np.concatenate([left.starts[: a[0]], starts[keep], r_starts[b[0] :]]),
                np.concatenate([left.ends[: a[0]], ends[keep], r_ends[b[0] :]]),
            )
        reach *= 2


def _agree(ids, starts, ends, w_ids, w_starts, w_ends, low: int, high: int):
    """Positions on both sides of a token that both have, lying within ``low`` and ``high``.

    A token that touches ``high`` does not count: it may have come from a cut text's end. Nor
    does one that begins inside a character, as its place is not told by its characters.
    """
    def within(starts, ends):
        whole = np.append(True, starts[1:] >= ends[:-1])[: len(starts)]
        return np.flatnonzero((starts >= low) & (ends < high) & whole)

    here = {(int(starts[i]), int(ends[i]), int(ids[i])): i for i in within(starts, ends)}
    for j in within(w_starts, w_ends):
        i = here.get((int(w_starts[j]), int(w_ends[j]), int(w_ids[j])))
        if i is not None:
            return int(i), int(j)
    return None


def join_nodes(tokenizer, left: Node, right: Node) -> Node:
    middle = [] if left.middle is None else left.middle
    joined = join_runs(tokenizer, left.head if left.middle is None else left.tail, right.head)
    if left.middle is None and right.middle is None:
        return Node(joined, None, None)
    if left.middle is None:
        return Node(joined, right.middle, right.tail)
    if right.middle is None:
        return Node(left.head, middle, joined)
    return Node(left.head, [*middle, joined.ids.tobytes(), *right.middle], right.tail)


def ids_of(node: Node) -> bytes:
    parts = [node.head.ids.tobytes(), *(node.middle or [])]
    return b"".join(parts + ([node.tail.ids.tobytes()] if node.tail else []))


def _run_fields(run: Run | None) -> tuple:
    if run is None:
        return None, None, None, None
    spans = [x.astype("<i8").tobytes() for x in (run.starts, run.ends)]
    return run.text, run.ids.astype("<u4").tobytes(), *spans


def _run_from(text, ids, starts, ends) -> Run:
    return Run(text, *(np.frombuffer(b, t) for b, t in ((ids, "<u4"), (starts, "<i8"), (ends, "<i8"))))


_LEAF_SCHEMA = ", ".join(
    ["key {key}", "hash bigint", "size bigint", "leaf int", "middle binary"]
    + [f"{side}_{part}" for side in ("head", "tail")
       for part in ("text string", "ids binary", "starts binary", "ends binary")]
)


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = DEFAULT,
    leaf: int = LEAF,
) -> DataFrame:
    """``key`` and ``ids`` (unsigned 32-bit little-endian integers) of every row's whole text."""
    small_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(text, F.lit("")).alias("text"))
    long = F.length("text") > leaf

    def short_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in pieces_of(batches, "text"):
            ids = [
                np.frombuffer(x, encoder.dtype).astype("<u4").tobytes()
                for x in encoder.encode(batch.column("text").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(ids, pa.binary())], ["key", "ids"]
            )

    def encode_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, encoder = load_tokenizer(tokenizer), word_encoder(tokenizer)

        def wide(part: str) -> bytes:
            (found,) = encoder.encode([part])
            return np.frombuffer(found, encoder.dtype).astype("<u4").tobytes()

        for batch in pieces_of(batches, "text"):
            nodes = [leaf_of(library, wide, t) for t in batch.column("text").to_pylist()]
            fields = list(zip(*(
                (n.middle and n.middle[0], *_run_fields(n.head), *_run_fields(n.tail))
                for n in nodes
            )))
            kinds = [pa.binary()] + [pa.string(), pa.binary(), pa.binary(), pa.binary()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("key", "hash", "size", "leaf")]
                + [pa.array(f, k) for f, k in zip(fields, kinds)],
                ["key", "hash", "size", "leaf", "middle",
                 *(f"{s}_{p}" for s in ("head", "tail") for p in ("text", "ids", "starts", "ends"))],
            )

    def join_leaves(group: pa.Table) -> pa.Table:
        library = load_tokenizer(tokenizer)
        found: dict[int, Node] = {}
        for r in group.to_pylist():
            head = _run_from(*(r[f"head_{p}"] for p in ("text", "ids", "starts", "ends")))
            if r["middle"] is None:
                found[r["leaf"]] = Node(head, None, None)
            else:
                tail = _run_from(*(r[f"tail_{p}"] for p in ("text", "ids", "starts", "ends")))
                found[r["leaf"]] = Node(head, [r["middle"]], tail)
        nodes = [found[i] for i in sorted(found)]
        while len(nodes) > 1:
            nodes = [
                join_nodes(library, *nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i]
                for i in range(0, len(nodes), 2)
            ]
        copies = group.num_rows // len(found)  # repeated rows have their leaves repeated
        return pa.table(
            [pa.array([group.column("key")[0].as_py()] * copies, group.schema.field("key").type),
             pa.array([ids_of(nodes[0])] * copies, pa.binary())],
            names=["key", "ids"],
        )

    short = rows.filter(~long).mapInArrow(short_ids, f"key {kind}, ids binary")
    leaves = rows.filter(long).select(
        "key", F.xxhash64("text").alias("hash"), F.length("text").cast("long").alias("size"),
        F.posexplode(F.transform(
            F.sequence(F.lit(0), F.floor((F.length("text") - 1) / leaf).cast("int")),
            lambda i: F.substring("text", i * leaf + 1, F.lit(leaf)),
        )).alias("leaf", "text"),
    )
    parts = leaves.repartition("key", "hash", "leaf").mapInArrow(
        encode_leaves, _LEAF_SCHEMA.format(key=kind)
    )
    joined = parts.groupBy("key", "hash", "size").applyInArrow(
        join_leaves, f"key {kind}, ids binary"
    )
    return short.unionByName(joined).withColumnRenamed("key", key)


def decode(encoded: DataFrame, key: str = "doc_id", tokenizer: str = DEFAULT) -> DataFrame:
    """``encoded`` with the column ``text``: the library's decoding of all ids, none skipped."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = load_tokenizer(tokenizer)
        for batch in pieces_of(batches, "ids", 4 << 20):
            ids = [np.frombuffer(x, "<u4").tolist() for x in batch.column("ids").to_pylist()]
            decoded = library.decode_batch(ids, skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), batch.column("ids"), pa.array(decoded, pa.string())],
                [key, "ids", "text"],
            )

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(texts, f"{key} {kind}, ids binary, text string")
