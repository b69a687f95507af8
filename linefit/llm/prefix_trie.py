"""Trie of conversation prefixes with counts per node, by minimal perfect hashes and flat arrays.

A prefix of d turns has a digest of two 64-bit sums of its turns' hashes, each times a power of its
place, so that running sums over a conversation give the digests of all its prefixes, and sums of
its parts can be put together. Equal digests must agree in depth, length and parent's digest, or
the job ends with an error.

A node is owned by the smallest conversation that has it; a conversation that owns one at depth d
owns all its deeper ones. Conversations are dealt over tasks in order of their ids and cut into
shards of about ``SHARD`` rows. A shard lists the distinct digests of its conversations' prefixes,
gives each a slot by a minimal perfect hash that keeps the digest for verification, scatters the
values of the nodes owned here into flat arrays, and adds them up through an array of parents'
slots, deepest first. What shards find for one digest is added up by Spark: a shard sends one row
per digest, however many conversations share it.

A conversation may be longer than a shard or a task's share: rows are dealt by (conversation,
place), running sums are put together over the tasks' borders, and what a lower part of a cut
conversation holds is added to all prefixes above the cut. Only a few rows per task go to the driver.

Edge cases: rows without a conversation's id take no part; a null role or text is empty. Turns
are ordered by number (null first), then role, then text; repeated rows are turns like any other.
An empty table has no node. Columns besides conversation, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.llm.common import discard, staged

SHARD = 65_536
IDS = 65_536
HEAVY = 1000
STEPS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # any two odd numbers with few factors 2 in number - 1
MASK = (1 << 64) - 1
MARK, TURN = 0, 1


# --- order of turns -------------------------------------------------------------------------


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each row's run of equal keys, and the starts of all runs."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return np.repeat(starts, np.diff(np.append(starts, len(keys)))), starts


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``nth``, the place of a row among its conversation's rows in this task."""
    last, before = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv").to_numpy()
        first, starts = _runs(conv)
        nth = np.arange(len(conv)) - first
        if conv[0] == last:
            nth[first == 0] += before
        last, before = conv[-1], int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nth)], [*batch.schema.names, "nth"])


def _border_conversations(table: DataFrame) -> list[int]:
    """Conversations that continue from one task's rows to the next one's: at most one per task."""
    ends = table.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high")).orderBy("part").collect()
    return sorted({a["high"] for a, b in zip(ends, ends[1:]) if a["high"] == b["low"]})


def _of(spark: SparkSession, convs: list[int]) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(c,) for c in convs], "conv long"))  # at most one per task


def turns(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, str]:
    """Staged (conv, kind, nth, a, b, bytes) and its path: each turn's place, hashes and length, and
    for each conversation a row of kind ``MARK``, which says that it exists."""
    spark = chats.sparkSession
    said = [F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    rows = chats.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"), *said
    )
    # the range's keys are as the sort's, but for the length of text that is sampled
    table, path = staged(
        rows.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 32))
        .sortWithinPartitions("conv", "turn", "role", "text")
        .select(
            "conv", F.spark_partition_id().alias("part"), F.xxhash64("role", "text").alias("a"),
            F.xxhash64(F.lit("second"), "text", "role").alias("b"), F.octet_length("text").cast("long").alias("bytes"),
        )
        .mapInArrow(_numbered, "conv long, part int, a long, b long, bytes long, nth long"),
        "turns",
    )
    borders = _border_conversations(table)
    if borders:
        counted = table.join(_of(spark, borders), "conv").groupBy("conv", "part").agg(F.count("*").alias("n"))
        before, seen = [], {}
        for r in counted.orderBy("conv", "part").collect():  # few rows per task
            before.append((r["conv"], r["part"], seen.get(r["conv"], 0)))
            seen[r["conv"]] = seen.get(r["conv"], 0) + r["n"]
        carry = spark.createDataFrame(before, "conv long, part int, before long")
        table = table.join(F.broadcast(carry), ["conv", "part"], "left").withColumn(
            "nth", F.col("nth") + F.coalesce("before", F.lit(0))
        )
    turn_rows = table.select("conv", F.lit(TURN).alias("kind"), "nth", "a", "b", "bytes")
    marks = table.where("nth = 0").select(
        "conv", F.lit(MARK).alias("kind"), F.lit(-1).cast("long").alias("nth"),
        *[F.lit(0).cast("long").alias(c) for c in ("a", "b", "bytes")],
    )
    return marks.unionByName(turn_rows), path


# --- digests of prefixes --------------------------------------------------------------------


class Powers:
    """Powers of a step modulo 2^64, for arrays of exponents."""

    def __init__(self, step: int):
        self.step = step
        self.low = np.multiply.accumulate(np.r_[np.uint64(1), np.full(4095, step, np.uint64)])
        self.high = np.ones(1, np.uint64)
        self.leap = np.uint64(pow(step, 4096, 1 << 64))

    def of(self, exponents: np.ndarray) -> np.ndarray:
        most = int(exponents.max(initial=0)) >> 12
        while len(self.high) <= most:
            self.high = np.append(self.high, np.multiply.accumulate(np.r_[self.high[-1:], np.full(len(self.high), self.leap, np.uint64)])[1:])
        return self.low[exponents & 4095] * self.high[exponents >> 12]


PREFIXES = (
    "conv long, part int, headless boolean, depth long, p1 long, p2 long, q1 long, q2 long, "
    "a long, b long, bytes long"
)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix digests (p) and those of their parents (q) from rows sorted by conversation and place.

    A conversation whose first row here is no mark is ``headless``: it has begun in an earlier
    task's rows, to whose sums its own must be added, or does not exist.
    """
    powers = [Powers(s) for s in STEPS]
    last, headless_before, depth_before, sums_before = None, False, 0, [np.uint64(0)] * 2
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv").to_numpy()
        mark = batch.column("kind").to_numpy() == MARK
        first, starts = _runs(conv)
        goes_on = conv[0] == last
        headless = ~mark[first]
        turn = (~mark).astype(np.int64)
        depth = np.cumsum(turn)
        depth -= (depth - turn)[first]
        if goes_on:
            same = first == 0
            headless[same] = headless_before
            depth[same] += depth_before
        out = []
        for i, name in enumerate("ab"):
            hashes = batch.column(name).to_numpy().view(np.uint64)
            terms = np.where(mark, np.uint64(0), hashes * powers[i].of(np.maximum(depth - 1, 0)))
            total = np.cumsum(terms)
            total -= (total - terms)[first]
            if goes_on:
                total[same] += sums_before[i]
            sums_before[i] = total[-1]
            out += [total.view(np.int64), (total - terms).view(np.int64)]
        last, headless_before, depth_before = conv[-1], bool(headless[-1]), int(depth[-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("part"), pa.array(headless), pa.array(depth),
             *[pa.array(out[i]) for i in (0, 2, 1, 3)], *[batch.column(c) for c in ("a", "b", "bytes")]],
            ["conv", "part", "headless", "depth", "p1", "p2", "q1", "q2", "a", "b", "bytes"],
        )


def _shifter(carry: dict[tuple[int, int], tuple[int, int, int]]):
    """Puts what earlier tasks hold of a conversation before its sums here."""

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            before = [carry[k] for k in zip(batch.column("conv").to_pylist(), batch.column("part").to_pylist())]
            depth = np.array([c[0] for c in before], np.int64)
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns["depth"] = pa.array(batch.column("depth").to_numpy() + depth)
            for i in (1, 2):
                power = Powers(STEPS[i - 1]).of(depth)
                start = np.array([c[i] for c in before], np.uint64)
                for name in (f"p{i}", f"q{i}"):
                    moved = start + power * columns[name].to_numpy().view(np.uint64)
                    columns[name] = pa.array(moved.view(np.int64))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return shifted


def prefixes(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """(conv, depth, p1, p2, q1, q2, a, b, bytes) of every prefix of every marked conversation, and
    the paths it reads, from rows (conv, kind, nth, a, b, bytes) in order of kind and nth."""
    spark = rows.sparkSession
    table, path = staged(
        rows.repartitionByRange("conv", "kind", "nth").sortWithinPartitions("conv", "kind", "nth")
        .withColumn("part", F.spark_partition_id()).mapInArrow(_summed, PREFIXES),
        "prefixes",
    )
    paths = [path]
    whole = table.where("not headless")
    borders = _border_conversations(table)
    if borders:
        ends = table.join(_of(spark, borders), "conv").groupBy("conv", "part").agg(
            F.max("depth").alias("n"), F.max_by("p1", "depth").alias("s1"), F.max_by("p2", "depth").alias("s2"),
            F.max("headless").alias("headless"),
        )
        carry, state = {}, {}
        for r in ends.orderBy("conv", "part").collect():  # few rows per task
            n, s1, s2 = state.get(r["conv"], (0, 0, 0))
            if r["headless"] and r["conv"] in state:
                carry[r["conv"], r["part"]] = n, s1, s2
            elif r["headless"]:
                continue  # a conversation that does not exist
            state[r["conv"]] = (
                n + r["n"], (s1 + pow(STEPS[0], n, 1 << 64) * r["s1"]) & MASK, (s2 + pow(STEPS[1], n, 1 << 64) * r["s2"]) & MASK,
            )
        if carry:
            keys = F.broadcast(spark.createDataFrame(list(carry), "conv long, part int"))  # few per task
            late = table.join(keys, ["conv", "part"], "left_semi").select(*table.columns)
            moved, moved_path = staged(late.mapInArrow(_shifter(carry), PREFIXES), "prefixes")
            paths.append(moved_path)
            whole = whole.unionByName(moved)
    return whole.drop("part", "headless"), paths


# --- nodes ----------------------------------------------------------------------------------


def _same(name: str):
    """The one value of a column in a group."""
    different = F.raise_error(F.lit("two prefixes share a digest"))
    return F.when(F.min(name).eqNullSafe(F.max(name)), F.min(name)).otherwise(different).alias(name)


def nodes_of(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """A row per distinct digest: its owner, parent's digest, members and members that end there."""
    none = [F.lit(None).cast("long").alias(c) for c in ("conv", "q1", "q2", "a", "b", "bytes")]
    counted = paths.select("p1", "p2", "depth", "conv", "q1", "q2", "a", "b", "bytes", F.lit(1).alias("n"), F.lit(0).alias("e"))
    ended = ends.select("p1", "p2", "depth", *none, F.lit(0).alias("n"), F.lit(1).alias("e"))
    return counted.unionByName(ended).groupBy("p1", "p2").agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n_convs"), F.sum("e").alias("n_ends"),
        *[_same(c) for c in ("depth", "q1", "q2", "a", "b", "bytes")],
    ).drop("a", "b")


class Slots:
    """A minimal perfect hash: distinct digests to 0 … n − 1, each verified by the digest kept.

    On each level the digests that are alone at their place of a table twice their number take it;
    the others go on to the next level. Places count in order of level and place.
    """

    def __init__(self, digests: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.kept = np.empty_like(digests)
        rest, used = np.arange(len(digests)), 0
        while len(rest):
            place = self._place(digests[rest], max(64, 2 * len(rest)))
            alone = np.bincount(place, minlength=max(64, 2 * len(rest))) == 1
            rank = used + np.cumsum(alone) - 1
            self.levels.append((alone, rank))
            here = alone[place]
            self.kept[rank[place[here]]] = digests[rest[here]]
            rest, used = rest[~here], used + int(alone.sum())

    def _place(self, digests: np.ndarray, size: int, level: int | None = None) -> np.ndarray:
        level = len(self.levels) if level is None else level
        x = digests[:, 0] ^ (digests[:, 1] * np.uint64(STEPS[0]) + np.uint64((level * STEPS[1]) & MASK))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        return ((x ^ (x >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Slots, −1 for digests that are not here."""
        found = np.full(len(digests), -1)
        rest = np.arange(len(digests))
        for level, (alone, rank) in enumerate(self.levels):
            place = self._place(digests[rest], len(alone), level)
            here = alone[place]
            found[rest[here]] = rank[place[here]]
            rest = rest[~here]
        known = found >= 0
        known[known] = (self.kept[found[known]] == digests[known]).all(axis=1)
        return np.where(known, found, -1)


def shard_totals(conv, depth, digest, parent, leaf, value):
    """(digests, leaves, values, cut rows) of one shard: sums over each prefix's owned descendants.

    The arrays have a row for each prefix of the shard's conversations, and one more for each node
    owned by them, with its value and whether it is a leaf. Cut rows are (conversation, depth,
    leaves, value) of prefixes whose parent is in another shard.
    """
    order = np.lexsort((digest[:, 1], digest[:, 0]))
    new = np.concatenate([[True], (digest[order][1:] != digest[order][:-1]).any(axis=1)])
    distinct = order[new]
    slots = Slots(digest[distinct])
    slot = slots.find(digest)
    n = len(distinct)
    at, of, deep = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64)
    mine = slot[distinct]
    at[mine], deep[mine] = distinct, depth[distinct]
    above = slots.find(parent[distinct])
    of[mine] = np.where(depth[distinct] > 0, above, -1)
    leaves, values = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(leaves, slot, leaf)
    np.add.at(values, slot, value)
    by_depth = np.argsort(-deep, kind="stable")
    edges = np.flatnonzero(np.diff(deep[by_depth])) + 1
    for some in np.split(by_depth, edges):
        some = some[of[some] >= 0]
        np.add.at(leaves, of[some], leaves[some])
        np.add.at(values, of[some], values[some])
    cut = np.flatnonzero((of < 0) & (deep > 0) & ((leaves > 0) | (values > 0)))
    some = np.flatnonzero((leaves > 0) | (values > 0))
    return digest[at[some]], leaves[some], values[some], (conv[at[cut]], deep[cut], leaves[cut], values[cut])


def _accumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals per digest of each shard, and its cut rows (kind 1), from rows sorted by conversation."""
    names = ["conv", "depth", "p1", "p2", "q1", "q2", "leaf", "value"]
    held: list[list[np.ndarray]] = []
    size = 0

    def closed(columns):
        if not columns[6].any() and not columns[7].any():
            return
        digest, parent = (np.stack(columns[i : i + 2], axis=1).view(np.uint64) for i in (2, 4))
        found, leaves, values, cut = shard_totals(columns[0], columns[1], digest, parent, *columns[6:])
        signed = found.view(np.int64)
        zeros, nothing = np.zeros(len(found), np.int64), np.zeros(len(cut[0]), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(pair)) for pair in (
                (zeros, nothing + 1), (signed[:, 0], cut[0]), (signed[:, 1], cut[1]), (leaves, cut[2]), (values, cut[3]),
            )],
            ["kind", "k1", "k2", "leaves", "value"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([batch.column(c).to_numpy() for c in names])
        size += batch.num_rows
        if size >= SHARD:
            columns = [np.concatenate(c) for c in zip(*held)]
            ends = np.flatnonzero(np.diff(columns[0])) + 1  # between conversations
            if len(ends):
                upto = int(ends[-1])
            else:  # one conversation: between depths, so that a prefix and its node stay together
                upto = int(np.flatnonzero(np.diff(columns[1], prepend=-1))[-1]) or size
            yield from closed([c[:upto] for c in columns])
            held, size = [[c[upto:] for c in columns]], size - upto
    if size:
        yield from closed([np.concatenate(c) for c in zip(*held)])


def _totals(paths: DataFrame, nodes: DataFrame) -> tuple[DataFrame, str]:
    """(p1, p2, leaves, value): sums over the nodes of each subtree, and the path read."""
    spark = paths.sparkSession
    zero = [F.lit(0).cast("long").alias(c) for c in ("leaf", "value")]
    rows = paths.select("conv", "depth", "p1", "p2", "q1", "q2", *zero).unionByName(nodes.select(
        "conv", "depth", "p1", "p2", "q1", "q2", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("value"),
    ))
    table, path = staged(
        rows.repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth")
        .mapInArrow(_accumulated, "kind long, k1 long, k2 long, leaves long, value long"),
        "totals",
    )
    totals = table.where("kind = 0").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), "leaves", "value")
    cuts = table.where("kind = 1").groupBy(F.col("k1").alias("conv"), F.col("k2").alias("below")).agg(
        F.sum("leaves").alias("leaves"), F.sum("value").alias("value")
    )
    # each prefix of a cut conversation gets what all cuts below it hold: one row of the steps
    here = "PARTITION BY conv ORDER BY below"
    steps = cuts.select(
        "conv", "below", F.expr(f"lag(below, 1, 0L) OVER ({here})").alias("from"),
        *[F.expr(f"sum({c}) OVER ({here} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)").alias(c) for c in ("leaves", "value")],
    )
    if not table.where("kind = 1").isEmpty():
        more = paths.join(steps, "conv").where("depth >= `from` AND depth < below").select("p1", "p2", "leaves", "value")
        totals = totals.unionByName(more)
    return totals.groupBy("p1", "p2").agg(F.sum("leaves").alias("leaves"), F.sum("value").alias("value")), path


# --- who ends where -------------------------------------------------------------------------


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ends sorted by (p1, p2, conv): a digest of the ids for each node that lies within the
    task's rows, and lists of at most ``IDS`` ids for those that may go on in another task's."""
    node, ids, size, open_, first_id = None, [], 0, True, 0
    out: list[tuple] = []

    def part(done: bool):
        text = ",".join(ids)
        if done:
            out.append((*node, 0, None, hashlib.sha256(text.encode()).hexdigest()))
        else:
            out.append((*node, first_id, text, None))

    def flushed():
        columns = list(zip(*out)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["p1", "p2", "first", "ids", "ends_sha256"]
        )
        out.clear()
        return batch

    for batch in batches:
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "conv"))):
            if key != node:
                if node is not None:
                    part(done=not open_)
                open_ = node is None  # the first node may have begun before
                node, ids, size, first_id = key, [], 0, conv
            elif size == IDS:
                part(done=False)
                open_, ids, size, first_id = True, [], 0, conv
            ids.append(str(conv))
            size += 1
        if len(out) > 10_000 or sum(len(o[3] or "") for o in out) > 4 << 20:
            yield flushed()
    if node is not None:
        part(done=False)
    yield flushed()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of lists sorted by (p1, p2, first), read one list at a time."""
    node, state, rows = None, None, []
    for batch in batches:
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in ("p1", "p2", "ids"))):
            if key == node:
                state.update(b",")
            else:
                if node is not None:
                    rows.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256()
            state.update(ids.encode())
    if node is not None:
        rows.append((*node, state.hexdigest()))
    columns = list(zip(*rows)) or [[]] * 3
    kinds = (pa.int64(), pa.int64(), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["p1", "p2", "ends_sha256"])


def _end_digests(ends: DataFrame) -> tuple[DataFrame, str]:
    """(p1, p2, ends_sha256) of nodes at which conversations end, and the path read."""
    listed, path = staged(
        ends.select("p1", "p2", "conv").repartitionByRange("p1", "p2", "conv").sortWithinPartitions("p1", "p2", "conv")
        .mapInArrow(_listed, "p1 long, p2 long, first long, ids string, ends_sha256 string"),
        "ends",
    )
    across = (
        listed.where("ids is not null").repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first")
        .select("p1", "p2", "ids").mapInArrow(_hashed, "p1 long, p2 long, ends_sha256 string")
    )
    return listed.where("ids is null").select("p1", "p2", "ends_sha256").unionByName(across), path


# --- the operator ---------------------------------------------------------------------------


def trie(rows: DataFrame) -> DataFrame:
    """A row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` (bytes that members after the first repeat, summed
    over the subtree) and ``ends_sha256`` (of the ids of conversations that end here).

    ``rows`` are those of :func:`turns`, or others like them: (conv, kind, nth, a, b, bytes) with a
    mark for each conversation. Rows of conversations without a mark count for nothing.
    """
    spark = rows.sparkSession
    paths, read = prefixes(rows)
    ends, ends_path = staged(paths.groupBy("conv").agg(
        F.max_by("p1", "depth").alias("p1"), F.max_by("p2", "depth").alias("p2"), F.max("depth").alias("depth")
    ), "last")
    nodes, nodes_path = staged(nodes_of(paths, ends), "nodes")
    totals, totals_path = _totals(paths, nodes)
    digests, listed_path = _end_digests(ends)

    def padded(df, *columns):
        kinds = {"conv": "long", "depth": "long", "q1": "long", "q2": "long", "n_convs": "long", "children": "long",
                 "leaves": "long", "value": "long", "ends_sha256": "string"}
        return df.select("p1", "p2", *[
            F.col(c) if c in columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()
        ])

    children = nodes.where("depth > 0").groupBy("q1", "q2").agg(F.count("*").alias("children")).select(
        F.col("q1").alias("p1"), F.col("q2").alias("p2"), "children")
    parts = (
        padded(nodes, "conv", "depth", "q1", "q2", "n_convs").unionByName(padded(children, "children"))
        .unionByName(padded(totals, "leaves", "value")).unionByName(padded(digests, "ends_sha256"))
    )
    merged, merged_path = staged(parts.groupBy("p1", "p2").agg(
        *[F.max(c).alias(c) for c in ("conv", "depth", "q1", "q2", "n_convs", "children", "leaves", "value", "ends_sha256")]
    ), "merged")
    discard(spark, *read, ends_path, nodes_path, totals_path, listed_path)

    total = merged.count()
    parents = merged.where("children > 0").select(
        F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent"), "children")
    heavy = parents.where(F.col("children") > F.lit(total / HEAVY)).drop("children")  # fewer than HEAVY rows
    below = merged.where("depth > 0")
    of_heavy = below.join(F.broadcast(heavy), ["q1", "q2"])
    of_others = below.join(F.broadcast(heavy.select("q1", "q2")), ["q1", "q2"], "left_anti").join(
        parents.drop("children").hint("merge"), ["q1", "q2"], "left")
    root = merged.where("depth = 0").withColumn("parent", F.lit(None).cast("long"))
    empty = hashlib.sha256(b"").hexdigest()
    return root.unionByName(of_heavy).unionByName(of_others).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs",
        F.coalesce("children", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(0)).alias("n_leaves"),
        F.coalesce("value", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
