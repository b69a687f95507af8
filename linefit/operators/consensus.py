"""Elastic net at any width by consensus: each task factorises its own rows once.

The squared errors are a sum over agents, which are tasks' rows. An agent's own problem, its rows'
errors and a pull towards the common weights, has a closed form once the agent's matrix is
factorised; the factor is stored in the shared folder. A round takes the common weights to all agents
and brings back the mean of theirs, so rounds read factors instead of rows and exchange weights only.
An agent's dual vector follows from the weights of all rounds so far, which every task gets; nothing
is kept in tasks, and one that is lost is run again.

Factors: where a task has more rows than features, the eigenvectors of its matrix of products
(width² numbers, however many rows); otherwise its standardised rows with the eigenvectors of
their inner products, block by block.

Rounds find which weights are in use; numbers are settled exactly. Every ``ROUNDS`` rounds the
products of the features in use come from one scan, the elastic net over them alone is solved on the
driver, and a second scan measures the optimality conditions of all weights. Features that
violate them join those in use, and once none does the solution is exact and the search over.
Where more than ``moments.WIDE`` are in use, rounds go on until they settle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from linefit.operators import moments as M
from linefit.operators.coordinates import sparse_weights
from linefit.operators.iterative import BlockRows, Model, Problem, Solution
from linefit.sources.staging import kept_table

EXACT = 1e-10
ROUNDS = 5
SWEEPS = 10_000
JOINED = 12  # times that features may join before rounds go on
RELAXED = 1.6
FACTORS = "agent long, share double, rows binary, basis binary, values binary, target binary"


def _factoriser(problem: Problem):
    """Blocks into agents: (share of all rows, standardised rows or none, basis, eigenvalues, Zᵀt/n)."""
    d, n = problem.rows.width, float(problem.n[0])
    center = problem.rows.origin + problem.mean[0]
    inverse = problem.inverse[0]

    def agent(number, share, rows, basis, values, target):
        kinds = (pa.int64(), pa.float64(), *[pa.binary()] * 4)
        packed = [None if a is None else np.ascontiguousarray(a).tobytes() for a in (rows, basis, values, target)]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip((number, share, *packed), kinds)],
            ["agent", "share", "rows", "basis", "values", "target"],
        )

    def factors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        products, target, count = 0.0, 0.0, 0
        for batch in batches:
            rows = batch.column("rows")
            for i in range(len(rows)):
                z = (np.frombuffer(rows[i].as_buffer()).reshape(-1, d + 1) - center) * inverse
                x, t = z[:, :-1], z[:, -1]
                if d <= len(x):
                    products, target, count = products + x.T @ x, target + t @ x, count + len(x)
                    continue
                values, basis = np.linalg.eigh(x @ x.T / n)
                number += 1
                yield agent(number, len(x) / n, x, basis, values, t @ x / n)
        if count:
            values, basis = np.linalg.eigh(products / n)
            yield agent(number + 1, count / n, None, basis, values, target / n)

    return factors


def _round(rounds: list[tuple[float, np.ndarray]], width: int, n: float):
    """One round: the agents' weights after the common ones of all ``rounds`` (pull, weights).

    An agent starts with a dual vector of zero and replays its rounds: they are products with its
    factor only.
    """

    def means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, apart = np.zeros(width), 0.0
        for batch in batches:
            for i in range(batch.num_rows):
                rows, basis, values, target = (
                    None if batch.column(c)[i].as_py() is None else np.frombuffer(batch.column(c)[i].as_buffer())
                    for c in ("rows", "basis", "values", "target")
                )
                share = batch.column("share")[i].as_py()
                basis = basis.reshape(len(values), -1)
                if rows is not None:
                    rows = rows.reshape(-1, width)
                dual, before = np.zeros(width), None
                for pull, common in rounds:
                    if before is not None:
                        own = RELAXED * x + (1 - RELAXED) * before[1]
                        dual = (dual + own - common) * (before[0] / pull)
                    weight = pull * share
                    side = target + weight * (common - dual)
                    if rows is None:
                        x = basis @ ((basis.T @ side) / (np.maximum(values, 0) + weight))
                    else:
                        inner = basis @ ((basis.T @ (rows @ side)) / (np.maximum(values, 0) + weight))
                        x = (side - rows.T @ inner / n) / weight
                    before = (pull, common)
                total += share * (RELAXED * x + (1 - RELAXED) * common + dual)
                apart += share * float((x - common) @ (x - common))
        yield pa.RecordBatch.from_arrays([pa.array([np.append(total, apart)], pa.list_(pa.float64()))], ["row"])

    return means


def solve(rows: BlockRows, strength: float, share: float, max_iter: int) -> Solution:
    """The elastic net over staged rows. ``gap`` is in standard units, as that of :mod:`iterative`."""
    problem = Problem(rows, [Model(strength, share)])
    d, n = rows.width, float(problem.n[0])
    relative = strength * problem.inverse[0, -1]
    absolute, square = relative * share, relative * (1 - share)
    factors, release = kept_table(
        rows.blocks.where("n > 0").select("rows").mapInArrow(_factoriser(problem), FACTORS), "factors", compression="none"
    )
    try:
        w, gap = _search(problem, factors, d, n, absolute, square, max_iter)
    finally:
        release()
    (found,) = problem.solutions(w[None], np.array([gap]))
    return found


def _search(problem: Problem, factors, d: int, n: float, absolute: float, square: float, max_iter: int):
    pull, common = 1.0, np.zeros(d)
    rounds = [(pull, common)]
    best, gap = common, np.inf
    usable = problem.inverse[0, :-1] > 0  # a constant feature has weight zero
    for number in range(1, max_iter + 1):
        found = _gathered(factors.mapInArrow(_round(rounds, d, n), "row array<double>"))
        mean, apart = found[:-1], float(np.sqrt(found[-1]))
        new = np.sign(mean) * np.maximum(np.abs(mean) - absolute / pull, 0.0) / (1 + square / pull) * usable
        moved = pull * float(np.linalg.norm(new - common))
        common = new
        settled = max(moved, apart) <= EXACT
        if number % ROUNDS == 0 or settled or number == max_iter:
            for w, violated in _exact(problem, common, absolute, square):
                if violated < gap:
                    best, gap = w, violated
            if gap <= EXACT or settled:
                break
            # keep the agents' distance from each other and from the last round in balance
            pull *= 2.0 if apart > 5 * moved else 0.5 if moved > 5 * apart else 1.0
        rounds.append((pull, common))
    return best, gap


def _exact(problem: Problem, w: np.ndarray, absolute: float, square: float):
    """(weights, violation) of ``w``, and of solutions over the features in use, which those that
    violate the conditions join; the last one is exact if nothing is left to join."""
    slope = problem.products(w[None], with_label=True)[0] + square * w
    violated = _violation(problem, w, slope, absolute)
    yield w, violated.max(initial=0.0)
    used = np.flatnonzero((w != 0) | (violated > EXACT) & (np.abs(slope) > absolute))
    for _ in range(JOINED):
        if len(used) > M.WIDE:
            return
        matrix, target = _products_of(problem, used)
        found, _ = sparse_weights(matrix, target, np.arange(len(used)), absolute, square, SWEEPS)
        w = np.zeros(len(w))
        w[used] = found
        slope = problem.products(w[None], with_label=True)[0] + square * w
        violated = _violation(problem, w, slope, absolute)
        yield w, violated.max(initial=0.0)
        joined = np.union1d(used, np.flatnonzero(violated > EXACT))
        if len(joined) == len(used):
            return
        used = joined


def _gathered(table) -> np.ndarray:
    branch = (F.spark_partition_id() % M.BRANCHES).alias("branch")
    summed = table.groupBy(branch).agg(Summarizer.sum(array_to_vector("row")).alias("row"))
    return summed.agg(Summarizer.sum(F.col("row")).alias("row")).first()["row"].toArray()


def _products_of(problem: Problem, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Correlations of the used features with each other and with the label, from one scan."""
    columns = [*used, -1]
    center = (problem.rows.origin + problem.mean[0])[columns]
    inverse, k = problem.inverse[0][columns], len(used)

    def products(z):
        s = (z[:, columns] - center) * inverse
        return (s[:, :-1].T @ s).ravel()

    if not k:
        return np.zeros((0, 0)), np.zeros(0)
    found = sum(problem.rows.totals(products, k * (k + 1)).values()).reshape(k, k + 1) / problem.n[0]
    return found[:, :-1], found[:, -1]


def _violation(problem: Problem, w: np.ndarray, slope: np.ndarray, absolute: float) -> np.ndarray:
    """How far each weight is from its optimality condition."""
    off = np.where(w != 0, np.abs(slope + absolute * np.sign(w)), np.maximum(np.abs(slope) - absolute, 0.0))
    return np.where(problem.inverse[0, :-1] > 0, off, 0.0)
