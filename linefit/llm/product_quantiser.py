"""Near-duplicate vectors by product quantisation over inverted lists.

Unit vectors are assigned to the nearest of about 2·√n coarse centroids and stored there as
their residual's codes in 8 subspaces, with the length of what the codes leave over. Every
vector also visits its nearest lists: tables of distances from its residual to all code words
give an asymmetric distance to each stored vector, and those that may be near enough (their
distance less what the codes leave over) are measured by cosine in double precision. The codes
thus never lose a pair; only the probes can, and ``PROBES`` of them suffice for recall near 1.
Centroids closer than ``APART`` are thinned out, so that a dense spot is one list rather than
many that its members would all have to visit.

Equal vectors are one class. Members and visitors of a list are dealt over blocks of bounded
size, so a hot list is many tasks. A block returns numbers of links and stars instead of pairs.

Vectors that are null, zero, of another width than most, or that hold a null or non-finite
component link with nothing; so do rows with a null id. Repeated rows count as other vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.llm.common import discard, salted_lookup, staged
from linefit.llm.components import components
from linefit.llm.vectors import common_width, matrix, usable

THRESHOLD, PROBES, APART = 0.95, 16, 0.4
SUBSPACES, WORDS = 8, 256
#: Vectors that centroids and code words are learnt from, and the most lists.
SAMPLE, LISTS = 65_536, 16_384
#: Members and visitors of a block.
MEMBERS, VISITORS = 4096, 8192


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def nearest_centroids(x: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the ``n`` nearest centroids, nearest first."""
    distance = (centroids**2).sum(axis=1) - 2 * x @ centroids.T
    n = min(n, len(centroids))
    if n == 1:
        return distance.argmin(axis=1)[:, None]
    some = np.argpartition(distance, n - 1, axis=1)[:, :n]
    order = np.argsort(np.take_along_axis(distance, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)


def k_means(x: np.ndarray, k: int, random, rounds: int = 8) -> np.ndarray:
    centroids = x[random.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([
            nearest_centroids(x[i : i + 4096], centroids, 1)[:, 0] for i in range(0, len(x), 4096)
        ])
        count = np.bincount(own, minlength=len(centroids))
        order = np.argsort(own, kind="stable")
        full = np.flatnonzero(count)
        starts = np.cumsum(count) - count
        centroids[full] = np.add.reduceat(x[order], starts[full], axis=0) / count[full, None]
    return centroids


def thinned(centroids: np.ndarray, counts: np.ndarray, apart: float) -> np.ndarray:
    """Centroids of which no two are closer than ``apart``; fuller ones stay."""
    kept: list[int] = []
    for i in np.argsort(-counts, kind="stable"):
        if not kept or ((centroids[kept] - centroids[i]) ** 2).sum(axis=1).min() >= apart**2:
            kept.append(int(i))
    return centroids[kept]


class Quantiser:
    """Coarse centroids and the residuals' code words."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 11):
        random = np.random.default_rng(seed)
        x = sample.astype(np.float32)
        centroids = k_means(x, lists, random)
        counts = np.bincount(nearest_centroids(x, centroids, 1)[:, 0], minlength=len(centroids))
        self.centroids = thinned(centroids, counts, APART)
        residual = x - self.centroids[nearest_centroids(x, self.centroids, 1)[:, 0]]
        self.parts = np.array_split(np.arange(x.shape[1]), min(SUBSPACES, x.shape[1]))
        self.words = [k_means(residual[:, p], WORDS, random) for p in self.parts]

    def codes(self, residual: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the length of what they leave over."""
        found = [nearest_centroids(residual[:, p], w, 1)[:, 0] for p, w in zip(self.parts, self.words)]
        left = sum(((residual[:, p] - w[c]) ** 2).sum(axis=1) for p, w, c in zip(self.parts, self.words, found))
        return np.stack(found, axis=1).astype(np.uint8), np.sqrt(left)

    def distances(self, residual: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances from residuals to coded ones, by table look-up."""
        total = np.zeros((len(residual), len(codes)), np.float32)
        for i, (p, w) in enumerate(zip(self.parts, self.words)):
            table = ((residual[:, None, p] - w[None]) ** 2).sum(axis=2)
            total += table[:, codes[:, i]]
        return np.sqrt(np.maximum(total, 0))


def _learn(classes: DataFrame, n: int, width: int) -> Quantiser:
    lists = max(1, min(LISTS, int(np.ceil(2 * np.sqrt(n)))))
    size = min(SAMPLE, max(20_000, 8 * lists))
    sample = classes.orderBy(F.xxhash64("rep"), "rep").select("v").limit(size).toArrow()
    return Quantiser(unit(matrix(sample.column("v"), width)), lists)


def _assign(quantiser: Quantiser, width: int, probes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                x = unit(matrix(batch.column("v"), width)).astype(np.float32)
                near = nearest_centroids(x, quantiser.centroids, probes).astype(np.int32)
                codes, left = quantiser.codes(x - quantiser.centroids[near[:, 0]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("rep"), batch.column("weight"), batch.column("v"),
                     pa.array(list(near), pa.list_(pa.int32())),
                     pa.array([c.tobytes() for c in codes], pa.binary()),
                     pa.array(left.astype(np.float64))],
                    ["rep", "weight", "v", "near", "code", "left"],
                )

    return run


def _compare(quantiser: Quantiser, width: int, threshold: float):
    radius = float(np.sqrt(2 - 2 * threshold))

    def run(members: pa.Table, visitors: pa.Table) -> pa.Table:
        if not members.num_rows or not visitors.num_rows:
            return _result([], [], [])
        m_ids, m_weights = (members.column(c).to_numpy() for c in ("rep", "weight"))
        v_ids, v_weights = (visitors.column(c).to_numpy() for c in ("rep", "weight"))
        home = visitors.column("home").to_numpy()
        y, x = (unit(matrix(t.column("v"), width)) for t in (members, visitors))
        codes = np.frombuffer(b"".join(members.column("code").to_pylist()), np.uint8).reshape(len(y), -1)
        near_enough = (radius + 1e-4 + members.column("left").to_numpy()).astype(np.float32)
        probes = np.array(members.column("near").to_pylist())
        centroid = quantiser.centroids[members.column("list")[0].as_py()]
        nodes = np.unique(np.concatenate([m_ids, v_ids]))
        parent, links = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        m_node, v_node = np.searchsorted(nodes, m_ids), np.searchsorted(nodes, v_ids)

        def roots(of: np.ndarray) -> np.ndarray:
            found = parent[of]
            while (parent[found] != found).any():
                found = parent[found]
            parent[of] = found
            return found

        for start in range(0, len(x), 256):
            part = slice(start, start + 256)
            residual = x[part].astype(np.float32) - centroid
            close = quantiser.distances(residual, codes) <= near_enough
            close &= v_node[part, None] != m_node[None]
            i, j = np.nonzero(close)
            if not len(i):
                continue
            if len(i) > close.size // 50:
                good = (x[part] @ y.T)[i, j] >= threshold
            else:
                good = np.einsum("ij,ij->i", x[part][i], y[j]) >= threshold
            i, j = i[good], j[good]
            if not len(i):
                continue
            links += np.bincount(v_node[part][i], weights=m_weights[j], minlength=len(nodes)).astype(np.int64)
            # a member that does not visit the visitor's list cannot find this link itself
            some, at = np.unique(home[part][i], return_inverse=True)
            own, row = np.unique(j, return_inverse=True)
            unseen = ~(probes[own][:, None, :] == some[None, :, None]).any(axis=2)[row, at]
            links += np.bincount(
                m_node[j[unseen]], weights=v_weights[part][i[unseen]], minlength=len(nodes)
            ).astype(np.int64)
            for a, b in zip(*(f(np.flatnonzero(np.diff(i, prepend=-1))) for f in (
                lambda s: s, lambda s: np.append(s[1:], len(i))))):
                linked = np.unique(roots(np.append(m_node[j[a:b]], v_node[part][i[a]])))
                parent[linked] = linked[0]
        top = roots(np.arange(len(nodes)))
        told = np.flatnonzero((links > 0) | (top != np.arange(len(nodes))))
        return _result(nodes[told], nodes[top[told]], links[told])

    return run


def _result(ids, roots, links) -> pa.Table:
    return pa.table([pa.array(c, pa.int64()) for c in (ids, roots, links)], names=["id", "root", "links"])


def _blocks(numbers: dict[int, int], most: int) -> dict[int, int]:
    return {k: -(-n // most) for k, n in numbers.items()}


def _counts(rows: DataFrame) -> dict[int, int]:
    return {r["list"]: r["count"] for r in rows.groupBy("list").count().collect()}  # at most LISTS


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding",
    threshold: float = THRESHOLD, probes: int = PROBES,
) -> DataFrame:
    """One row per row: key, n_links, component_id, kept (it is its component's smallest id)."""
    spark = rows.sparkSession
    width = common_width(rows, vector) or 1
    own = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    fit = own.where(F.col("id").isNotNull() & usable("v") & (F.size("v") == width))
    classes, classes_path = staged(
        fit.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("weight")), "classes"
    )
    n = classes.count()
    if n == 0:
        return own.select(
            F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"),
        )
    quantiser = _learn(classes, n, width)
    kind = classes.schema["v"].dataType.simpleString()
    stored, stored_path = staged(
        classes.mapInArrow(
            _assign(quantiser, width, probes),
            f"rep long, weight long, v {kind}, near array<int>, code binary, left double",
        ), "coded",
    )
    members = stored.withColumn("list", F.col("near")[0])
    again = spark.read.schema(stored.schema).parquet(stored_path)
    visitors = again.select("rep", "weight", "v", F.col("near")[0].alias("home"), F.explode("near").alias("list"))
    m_blocks, v_blocks = _blocks(_counts(members), MEMBERS), _blocks(_counts(visitors.select("list")), VISITORS)
    lists = sorted(m_blocks)
    shape = spark.createDataFrame(
        [(i, m_blocks[i], v_blocks.get(i, 1)) for i in lists], "list int, mb int, vb int"
    )

    def dealt(table: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one of its own side's blocks, for every block of the other side."""
        table = table.join(F.broadcast(shape), "list")  # at most LISTS rows
        mine = F.pmod(F.xxhash64("rep"), F.col(own)).cast("int")
        return table.withColumn(f"_{own}", mine).withColumn(
            f"_{other}", F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        ).drop(own, other)

    keys = ["list", "_mb", "_vb"]
    found, found_path = staged(
        dealt(members, "mb", "vb").groupBy(*keys).cogroup(dealt(visitors, "vb", "mb").groupBy(*keys))
        .applyInArrow(_compare(quantiser, width, threshold), "id long, root long, links long"),
        "links",
    )
    groups, groups_path = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("links"))
    classed = classes.select("rep", "weight").join(links, "rep", "left").join(
        groups.select(F.col("node").alias("rep"), "component"), "rep", "left"
    ).select(
        "rep", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    results, _ = staged(classed.where("n_links > 0"), "results")
    repeated, _ = staged(classes.where("weight > 1").select("v", "rep"), "repeated")
    discard(spark, found_path, stored_path, groups_path, classes_path)
    if repeated.isEmpty():
        placed = own.select("id", F.col("id").alias("rep"))
    else:
        placed = salted_lookup(own, "v", repeated, F.col("id")).select(
            "id", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep")
        )
    return salted_lookup(placed, "rep", results, F.col("id")).select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        (F.coalesce("component_id", "id") == F.col("id")).alias("kept"),
    )
