"""Nearest neighbours from a forest of sorted hash strings (Bawa et al., 2005, by blocks).

The rows are dealt into blocks of bounded size; each block holds its own trees. A tree hashes
every vector to a string of 64 bits: 16 random projections, each cut at its quantiles into 16
cells, their bits interleaved from the most significant on, so a longer common prefix means a
smaller common cell, and dense regions get finer cells. A tree is the sorted array of its
strings. A query descends every tree to its longest matching prefix and then ascends all trees
together, one bit at a time. Candidates are measured exactly as they are met.

Rows are dealt over blocks at random, and every query to all blocks; both come by a shuffle, sorted
so that a task holds one block and streams the queries past it. Equal or nearly equal vectors
fill blocks like any others, so a hot vector needs no care. A query first meets about ``FIRST``
rows of each block, then ``SECOND``. If the nearest of all blocks are the same both times, they
are its answer; otherwise it ascends until it has met ``CANDIDATES`` of each block. So vectors with
near neighbours meet a small part of all rows, and those whose neighbours are hardly nearer than
the rest, where a longer prefix says little, most of them.

Rows whose id is null, or whose vector is null, zero, of another width than most, or holds a
null or non-finite component take no part. Repeated rows count as often as they occur, except
that a row never is its own query's neighbour; of rows that share a query's id the one with the
smallest vector asks. An empty table gives no rows; columns besides id and vector are not read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linefit.llm.common import named, staged
from linefit.llm.vectors import common_width, matrix, usable

TREES, PROJECTIONS, LEVELS = 32, 16, 4
#: Rows of a block, and distinct candidates a query meets in each in the first, second and third
#: round before it stops ascending.
BLOCK, FIRST, SECOND, CANDIDATES = 8192, 48, 160, 4096
#: Queries that are measured together.
QUERIES = 256


class Forest:
    """Trees over the rows of a matrix."""

    def __init__(self, data: np.ndarray, trees: int = TREES, seed: int = 7):
        self.data = data
        self.bits = PROJECTIONS * LEVELS
        random = np.random.default_rng(seed)
        self.planes = random.standard_normal((trees, data.shape[1], PROJECTIONS))
        steps = np.arange(1, 1 << LEVELS) / (1 << LEVELS)
        self.cuts, self.order, self.keys = [], [], []
        for planes in self.planes:
            seen = data @ planes
            cuts = np.quantile(seen, steps, axis=0)
            keys = self._strings(seen, cuts)
            order = np.argsort(keys, kind="stable")
            self.cuts.append(cuts)
            self.order.append(order)
            self.keys.append(keys[order])

    def _strings(self, seen: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        keys = np.zeros(len(seen), np.uint64)
        cells = np.stack([np.searchsorted(c, s) for c, s in zip(cuts.T, seen.T)], axis=1)
        for level in reversed(range(LEVELS)):
            for p in range(PROJECTIONS):
                keys = keys << np.uint64(1) | (cells[:, p] >> level & 1).astype(np.uint64)
        return keys

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in each tree the strings lie that share a query's first bits: (bits, tree, query)."""
        hashed = [self._strings(queries @ p, c) for p, c in zip(self.planes, self.cuts)]
        low = np.empty((self.bits + 1, len(hashed), len(queries)), np.int32)
        high = np.empty_like(low)
        for t, (keys, own) in enumerate(zip(self.keys, hashed)):
            low[0, t], high[0, t] = 0, len(keys)
            for depth in range(1, self.bits + 1):
                rest = np.uint64((1 << (self.bits - depth)) - 1)
                low[depth, t] = np.searchsorted(keys, own & ~rest, side="left")
                high[depth, t] = np.searchsorted(keys, own | rest, side="right")
        return low, high

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """Row numbers for each query: all that share the longest prefixes, by whole prefixes."""
        low, high = self.ranges(queries)
        met = (high - low).sum(axis=1)  # with repeats, so an upper bound of what is met
        for q in range(len(queries)):
            depth = int(np.flatnonzero(met[:, q] >= min(enough, met[0, q]))[-1])
            seen = np.zeros(len(self.data), bool)
            for at in range(depth, -1, -1):
                for t, order in enumerate(self.order):
                    seen[order[low[at, t, q] : high[at, t, q]]] = True
                found = np.flatnonzero(seen)
                if len(found) >= enough:
                    break
            yield found

    def nearest(
        self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, enough: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """For each query the rows found nearest, their distances, and how many were measured."""
        for query, itself, near in zip(queries, own, self.candidates(queries, enough)):
            met, near = len(near), near[ids[near] != itself]
            score = np.sqrt(((self.data[near] - query) ** 2).sum(axis=1))
            best = np.lexsort((ids[near], score))[:k]
            yield near[best], score[best], met


def nearest(
    rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10,
    block: int = BLOCK, enough: int = CANDIDATES, queries_at_once: int = QUERIES, measured: bool = False,
) -> DataFrame:
    """The ``k`` nearest rows found for every row with ``is_query``: query_id, rank, vec_id, score.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller id. With
    ``measured`` there is a further column: how many rows all rounds measured for the query.
    """
    id_, v = named(key), named(vector)
    usable_rows = rows.where(id_.isNotNull() & usable(v))
    width = common_width(rows, v) or 1
    fit = usable_rows.where(F.size(v) == width).select(
        id_.cast("long").alias("id"), v.alias("v"), is_query.alias("q")
    )
    blocks = max(1, -(-fit.count() // block))
    dealt = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    data = fit.select(dealt.alias("block"), F.lit(0).alias("kind"), "id", "v")
    asked = fit.where("q").groupBy("id").agg(F.min("v").alias("v"))
    tasks = min(max(blocks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 20_000)
    ranked = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))

    def round_of(queries: DataFrame, most: int) -> DataFrame:
        """(query_id, rank, vec_id, score), and if ``measured`` as rank 0 the rows measured as score."""
        to_all = queries.select(
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "id", "v"
        )
        found = (
            data.unionByName(to_all).repartition(tasks, "block").sortWithinPartitions("block", "kind", "id")
            .mapInArrow(_search(width, k, most, queries_at_once), "query_id long, vec_id long, score double")
        )
        best = found.where("vec_id is not null").withColumn("rank", ranked).where(F.col("rank") <= k)
        best = best.select("query_id", "rank", "vec_id", "score")
        if not measured:
            return best
        met = found.where("vec_id is null").groupBy("query_id").agg(F.sum("score").alias("score"))
        return best.unionByName(
            met.select("query_id", F.lit(0).alias("rank"), F.lit(None).cast("long").alias("vec_id"), "score")
        )

    first, _ = staged(round_of(asked, min(FIRST, enough)), "nearest")
    second, _ = staged(round_of(asked, min(SECOND, enough)), "nearest")
    seen = first.unionByName(second).where("rank > 0").groupBy("query_id", "vec_id").agg(F.count("*").alias("n"))
    changed = seen.where("n = 1").select(F.col("query_id").alias("id")).distinct()
    third, _ = staged(round_of(asked.join(changed, "id", "left_semi"), enough), "nearest")
    settled = second.join(changed.withColumnRenamed("id", "query_id"), "query_id", "left_anti")
    best = settled.unionByName(third)
    out = best.where("rank > 0").select("query_id", "rank", "vec_id", "score")
    if not measured:
        return out
    met = first.unionByName(second).unionByName(third).where("rank = 0").groupBy("query_id").agg(F.sum("score").cast("long").alias("measured"))
    return out.join(met, "query_id")


def _search(width: int, k: int, enough: int, at_once: int):
    """Rows sorted by block, the block's own first: the best of each block for each query, and a
    row without a neighbour that has as score how many rows were measured."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, forest, ids = None, [], None, None
        for batch in batches:
            where, kind = batch.column("block").to_numpy(), batch.column("kind").to_numpy()
            edges = np.flatnonzero((where[1:] != where[:-1]) | (kind[1:] != kind[:-1])) + 1
            for start, end in zip([0, *edges.tolist()], [*edges.tolist(), len(where)]):
                part = batch.slice(start, end - start)
                if start == end:
                    continue
                own, data = part.column("id").to_numpy(), matrix(part.column("v"), width)
                if where[start] != block:
                    block, held, forest = where[start], [], None
                if kind[start] == 0:
                    held.append((own, data))
                    continue
                if not held:
                    continue
                if forest is None:
                    ids, forest = np.concatenate([h[0] for h in held]), Forest(np.concatenate([h[1] for h in held]))
                for at in range(0, len(own), at_once):
                    some = own[at : at + at_once]
                    near = list(forest.nearest(data[at : at + at_once], some, ids, k, enough))
                    sizes = [len(best) for best, _, _ in near]
                    query = np.concatenate([np.repeat(some, sizes), some])
                    found = np.concatenate([ids[best] for best, _, _ in near])
                    score = np.concatenate([*(score for _, score, _ in near), [met for _, _, met in near]])
                    none = np.arange(len(query)) >= len(found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query, pa.int64()), pa.array(np.append(found, np.zeros(len(some), np.int64)), mask=none),
                         pa.array(score, pa.float64())],
                        ["query_id", "vec_id", "score"],
                    )

    return run
