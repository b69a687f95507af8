"""Ridge and elastic net at any width, without a matrix of products.

The rows are staged once as binary matrices (:class:`BlockRows`). Every iteration reads them in
one aggregate, which carries the weights of all models through a block as one matrix product.
Rows are standardised on the way, so the problem solved is that of :class:`linear.RidgePath`:
conjugate gradients settle the ridge systems, proximal steps with momentum the elastic nets.

The strengths of a grid share a fold's Krylov space (:func:`solve_shifted`): one vector per fold
goes through the rows, and the solutions of all strengths follow from its image.

A task sends (groups × vectors × width) numbers per iteration; they are added in two steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefit.functions import vectors as V
from linefit.operators import moments as M
from linefit.sources.staging import kept_table

TOLERANCE = 1e-11
BLOCK_BYTES = 4 << 20
#: Bytes of rows or blocks that go to Python at once; Spark's own 64 MB would be held several times
#: over, by the JVM and the worker of each task.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@dataclass(frozen=True)
class Model:
    """A strength, its share of absolute penalty, and the group its training leaves out."""

    strength: float
    share: float = 0.0
    left_out: int | None = None


@dataclass
class Solution:
    weights: np.ndarray
    intercept: float
    gap: float  # largest violation of the optimality conditions, in standard units


class Rows:
    """Rows of (group, features, label), read again by each :meth:`totals`."""

    def __init__(self, df: DataFrame, label: str, features: str, by: Column | None, width: int):
        group = F.lit(0) if by is None else by.cast("int")
        self.width = width
        self.table = df.select(
            group.alias("group"), V.as_array(df, features).alias("x"),
            F.col(label).cast("double").alias("y"),
        )

    def partials(self, function, length: int) -> DataFrame:
        """(group, row) of each task: its sum of ``function(z)`` over matrices z of rows, and as
        group −1 the number of unusable rows."""
        read = M._batch_reader(self.width)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            bad = 0
            for batch, z, position, unusable in read(batches):
                bad += unusable
                groups = batch.column("group").to_numpy(zero_copy_only=False)[position]
                for g in np.unique(groups):
                    found = function(z[groups == g])
                    sums[int(g)] = sums[int(g)] + found if int(g) in sums else found
            if bad:
                sums[-1] = np.append(float(bad), np.zeros(length - 1))
            yield _sums_batch(sums)

        return self.table.mapInArrow(partial, SUMS)

    def totals(self, function, length: int) -> dict[int, np.ndarray]:
        """Sum per group of ``function(z)``, ``length`` numbers for a matrix of rows."""
        branch = (F.spark_partition_id() % M.BRANCHES).alias("branch")
        table = (
            self.partials(function, length)
            .groupBy("group", branch).agg(Summarizer.sum(array_to_vector("row")).alias("row"))
            .groupBy("group").agg(Summarizer.sum(F.col("row")).alias("row"))
            .collect()  # one row of ``length`` numbers per group
        )
        found = {r["group"]: r["row"].toArray() for r in table}
        if -1 in found:
            raise _bad_rows(int(found[-1][0]))
        if not found:
            raise ValueError("no rows to fit on")
        return found

    def first_row(self) -> np.ndarray | None:
        """Features and label of some row, None if there is none."""
        first = self.table.first()
        if first is None:
            return None
        return np.append(np.array(first["x"] or [0.0] * self.width, float), first["y"] or 0.0)

    def scales(self) -> dict[int, np.ndarray]:
        """Per group: n, sums and sums of squares around a first row's values."""
        origin = self.first_row()
        if origin is None:
            raise ValueError("no rows to fit on")
        if origin.shape != (self.width + 1,) or not np.isfinite(origin).all():
            origin = np.zeros(self.width + 1)
        self.origin = origin

        def sums(z):
            d = z - origin
            return np.concatenate([[len(z)], d.sum(axis=0), (d * d).sum(axis=0)])

        return self.totals(sums, 2 * self.width + 3)


SUMS = "group int, row array<double>"
BLOCKS = "block long, group int, n int, bad long, rows binary"


def _sums_batch(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.list_(pa.float64()))],
        ["group", "row"],
    )


def _bad_rows(bad: int) -> M.BadRows:
    return M.BadRows(f"{bad} rows hold a null, non-finite or wrongly sized value; "
                     "take them out first (see finite_rows)")


class BlockRows(Rows):
    """The same rows, staged once as matrices of doubles (features…, label) of at most
    ``BLOCK_BYTES``, each of one group; :meth:`release` removes them. Until then the session passes
    rows to Python in batches of ``BATCH_BYTES``."""

    def __init__(self, df: DataFrame, label: str, features: str, by: Column | None, width: int):
        super().__init__(df, label, features, by, width)
        self.spark, self.limit = df.sparkSession, df.sparkSession.conf.get(BATCH_LIMIT)
        self.spark.conf.set(BATCH_LIMIT, f"{BATCH_BYTES}b")
        try:
            self.blocks, self.remove = kept_table(
                self.table.mapInArrow(_packer(width), BLOCKS), "row-blocks", **_few_in_memory()
            )
        except BaseException:
            self.spark.conf.set(BATCH_LIMIT, self.limit)
            raise
        try:
            bad = self.blocks.agg(F.sum("bad")).first()[0]
            if bad:
                raise _bad_rows(bad)
        except BaseException:
            self.release()
            raise

    def release(self) -> None:
        self.spark.conf.set(BATCH_LIMIT, self.limit)
        self.remove()

    def __enter__(self) -> BlockRows:
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def partials(self, function, length: int) -> DataFrame:
        columns = self.width + 1

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                rows = batch.column("rows")
                for i, g in enumerate(batch.column("group").to_pylist()):
                    z = np.frombuffer(rows[i].as_buffer()).reshape(-1, columns)
                    found = function(z)
                    sums[g] = sums[g] + found if g in sums else found
            yield _sums_batch(sums)

        return self.blocks.where("n > 0").select("group", "rows").mapInArrow(partial, SUMS)

    def first_row(self) -> np.ndarray | None:
        head = F.expr(f"substring(rows, 1, {8 * (self.width + 1)})").alias("head")
        first = self.blocks.where("n > 0").select(head).first()
        return None if first is None else np.frombuffer(bytes(first["head"]))


def _few_in_memory() -> dict[str, str]:
    """Options for blocks as Parquet: row groups and pages of a block or two, which a writer and a
    reader hold whole. By default the first hundred rows are held before their size is looked at."""
    return {
        "compression": "none", "parquet.block.size": str(BLOCK_BYTES),
        "parquet.page.size.row.check.min": "1", "parquet.enable.dictionary": "false",
    }


def _packer(width: int):
    """Rows of (group, x, y) into blocks; a last row without any counts the unusable rows."""
    read = M._batch_reader(width)
    most = max(1, BLOCK_BYTES // (8 * (width + 1)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        sizes: dict[int, int] = {}
        number, bad = TaskContext.get().partitionId() << 32, 0

        def block(group, z, unusable=0):
            nonlocal number
            number += 1
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
            values = (number, group, len(z), unusable, z.tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(values, kinds)], ["block", "group", "n", "bad", "rows"]
            )

        for batch, z, position, unusable in read(batches):
            bad += unusable
            groups = batch.column("group").to_numpy(zero_copy_only=False)[position]
            for g in np.unique(groups).tolist():
                held.setdefault(g, []).append(z[groups == g])
                sizes[g] = sizes.get(g, 0) + len(held[g][-1])
                if sizes[g] >= most:
                    whole = np.concatenate(held[g])
                    for start in range(0, len(whole) - most + 1, most):
                        yield block(int(g), whole[start : start + most])
                    rest = whole[len(whole) // most * most :]
                    held[g], sizes[g] = [rest], len(rest)
        for g, parts in held.items():
            if sizes[g]:
                yield block(int(g), np.concatenate(parts))
        if bad:
            yield block(0, np.zeros((0, width + 1)), bad)

    return packed


class Problem:
    """All models over the same rows, in standard units of each one's training rows."""

    def __init__(self, rows: Rows, models: Sequence[Model], scales: dict | None = None):
        self.rows, self.models = rows, list(models)
        self.scales = rows.scales() if scales is None else scales
        self.groups = sorted(self.scales)
        d = rows.width
        mean, deviation, self.n = [], [], []
        for m in self.models:
            total = sum(v for g, v in self.scales.items() if g != m.left_out)
            n, s, q = total[0], total[1 : d + 2], total[d + 2 :]
            mean.append(s / n)
            variance = np.maximum(q / n - (s / n) ** 2, 0.0)
            variance[variance <= (1e-14 * np.abs(rows.origin + s / n)) ** 2] = 0.0
            deviation.append(np.sqrt(variance))
            self.n.append(n)
        self.mean, self.deviation = np.array(mean), np.array(deviation)
        self.inverse = np.divide(1.0, self.deviation, out=np.zeros_like(self.deviation), where=self.deviation > 0)

    def products(self, w: np.ndarray, with_label: bool = False) -> np.ndarray:
        """For each model Zᵀ(Z w − t) / n over its training rows (t only ``with_label``)."""
        d, origin = self.rows.width, self.rows.origin
        mean, inverse = self.mean, self.inverse
        left_out = [m.left_out for m in self.models]
        raw = w * inverse[:, :d]  # weights of unscaled, centred features
        offset = (raw * mean[:, :d]).sum(axis=1)
        models = len(self.models)

        def gradient(z):
            x = z[:, :d] - origin[:d]
            error = x @ raw.T - offset
            if with_label:
                error -= ((z[:, d] - origin[d])[:, None] - mean[:, d]) * inverse[:, d]
            return np.concatenate([(error.T @ x).ravel(), error.sum(axis=0)])

        found = self.rows.totals(gradient, models * (d + 1))
        total = np.zeros((models, d))
        for k in range(models):
            parts = [found[g] for g in self.groups if g != left_out[k]]
            total[k] = sum(p[k * d : (k + 1) * d] for p in parts)
            total[k] -= mean[k, :d] * sum(p[models * d + k] for p in parts)
            total[k] *= inverse[k, :d] / self.n[k]
        return total

    def solve(self, max_iter: int) -> list[Solution]:
        relative = np.array([
            m.strength * i for m, i in zip(self.models, self.inverse[:, -1])
        ])[:, None]
        share = np.array([m.share for m in self.models])[:, None]
        w, gap = (
            self._proximal(relative * share, relative * (1 - share), max_iter)
            if share.any() else self._conjugate(relative, max_iter)
        )
        return self.solutions(w, gap)

    def solutions(self, w: np.ndarray, gap: np.ndarray) -> list[Solution]:
        """Weights in standard units as those of the rows, with intercepts."""
        d, out = self.rows.width, []
        for k in range(len(self.models)):
            weights = w[k] * self.deviation[k, -1] * self.inverse[k, :d]
            mean = self.rows.origin + self.mean[k]
            out.append(Solution(weights, float(mean[-1] - weights @ mean[:-1]), float(gap[k])))
        return out

    def _conjugate(self, strength: np.ndarray, max_iter: int) -> tuple[np.ndarray, np.ndarray]:
        w = np.zeros((len(self.models), self.rows.width))
        residual = -self.products(w, with_label=True)
        start = np.abs(residual).max(axis=1, keepdims=True)
        direction, size = residual.copy(), (residual**2).sum(axis=1, keepdims=True)
        for _ in range(max_iter):
            if (np.abs(residual) <= TOLERANCE * start).all():
                break
            image = self.products(direction) + strength * direction
            along = (direction * image).sum(axis=1, keepdims=True)
            step = np.divide(size, along, out=np.zeros_like(size), where=along > 0)
            w, residual = w + step * direction, residual - step * image
            new = (residual**2).sum(axis=1, keepdims=True)
            direction = residual + np.divide(new, size, out=np.zeros_like(new), where=size > 0) * direction
            size = new
        return w, np.abs(residual).max(axis=1)

    def _proximal(self, absolute: np.ndarray, square: np.ndarray, max_iter: int):
        """Accelerated proximal gradient with restarts; steps by the largest curvature met."""
        w = np.zeros((len(self.models), self.rows.width))
        probe = np.ones_like(w) / np.sqrt(w.shape[1])
        for _ in range(8):
            image = self.products(probe)
            curvature = np.linalg.norm(image, axis=1, keepdims=True)
            probe = np.divide(image, curvature, out=np.zeros_like(image), where=curvature > 0)
        bound = 1.2 * np.maximum(curvature, 1e-12) + square
        ahead, pace, gap = w, np.ones((len(w), 1)), np.full(len(w), np.inf)
        for _ in range(max_iter):
            slope = self.products(ahead, with_label=True) + square * ahead
            moved = ahead - slope / bound
            new = np.sign(moved) * np.maximum(np.abs(moved) - absolute / bound, 0.0)
            gap = (bound * np.abs(new - ahead)).max(axis=1)
            if (gap <= TOLERANCE).all():
                w = new
                break
            back = ((ahead - new) * (new - w)).sum(axis=1, keepdims=True) > 0
            pace = np.where(back, 1.0, pace)
            faster = (1 + np.sqrt(1 + 4 * pace**2)) / 2
            ahead = new + np.where(back, 0.0, (pace - 1) / faster) * (new - w)
            w, pace = new, faster
        return w, gap


def solve(
    df: DataFrame, models: Sequence[Model], label: str, features: str, width: int,
    by: Column | None = None, max_iter: int = 1000,
) -> list[Solution]:
    """Solutions of all ``models``, from aggregates over the rows of ``df``, staged once."""
    with BlockRows(df, label, features, by, width) as rows:
        return Problem(rows, models).solve(max_iter)


def solve_shifted(
    rows: Rows, strengths: Sequence[float], left_out: Sequence[int | None], max_iter: int = 1000
) -> dict[tuple[float, int | None], Solution]:
    """Ridge solutions for every strength and every group left out (None: none), by conjugate
    gradients for shifted systems.

    The systems of one group differ by a multiple of the identity, so their residuals stay
    multiples (``part``) of that of the smallest strength, the slowest to settle. The rows are
    read once per iteration with one direction for each group; a last pass measures all gaps.
    """
    strengths = sorted(set(strengths))
    base = Problem(rows, [Model(strengths[0], left_out=f) for f in left_out])
    unit = base.inverse[:, -1:]  # strengths are in units of the label's deviation
    shift = (np.array(strengths) - strengths[0]) * unit
    lowest = strengths[0] * unit
    shape = (len(base.models), len(strengths), rows.width)
    w = np.zeros(shape)
    residual = -base.products(np.zeros((shape[0], shape[2])), with_label=True)
    start = np.abs(residual).max(axis=1, keepdims=True)
    direction, size = residual.copy(), (residual**2).sum(axis=1, keepdims=True)
    directions = np.repeat(residual[:, None], shape[1], axis=1)
    part = before = np.ones(shape[:2])
    last_step, last_ratio = np.ones((shape[0], 1)), np.zeros((shape[0], 1))

    def share(a, b):
        return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=b != 0)

    for _ in range(max_iter):
        if (np.abs(residual) <= TOLERANCE * start).all():
            break
        image = base.products(direction) + lowest * direction
        step = share(size, (direction * image).sum(axis=1, keepdims=True))
        bend = step * last_ratio * (before - part) + before * last_step * (1 + shift * step)
        after = share(part * before * last_step, bend)
        w += (step * share(after, part))[..., None] * directions
        residual = residual - step * image
        new = (residual**2).sum(axis=1, keepdims=True)
        ratio = share(new, size)
        directions = after[..., None] * residual[:, None] + (ratio * share(after, part) ** 2)[..., None] * directions
        direction = residual + ratio * direction
        size, before, part, last_step, last_ratio = new, part, after, step, ratio

    models = [Model(s, left_out=f) for f in left_out for s in strengths]
    whole = Problem(rows, models, base.scales)
    flat = w.reshape(-1, rows.width)
    relative = np.array([m.strength * i for m, i in zip(models, whole.inverse[:, -1])])[:, None]
    gap = np.abs(whole.products(flat, with_label=True) + relative * flat).max(axis=1)
    return {(m.strength, m.left_out): s for m, s in zip(models, whole.solutions(flat, gap))}


def squared_errors(
    df: DataFrame, lines: Sequence[tuple[np.ndarray, float]], label: str, features: str,
    by: Column | None = None,
) -> dict[int, tuple[int, np.ndarray]]:
    """Per group: rows, and the sum of squared errors of each (weights, intercept), row by row."""
    return errors_over(Rows(df, label, features, by, len(lines[0][0])), lines)


def errors_over(rows: Rows, lines: Sequence[tuple[np.ndarray, float]]) -> dict[int, tuple[int, np.ndarray]]:
    weights = np.array([w for w, _ in lines], float)
    intercepts = np.array([b for _, b in lines], float)

    def squares(z):
        error = z[:, :-1] @ weights.T + intercepts - z[:, -1:]
        return np.append(len(z), (error * error).sum(axis=0))

    found = rows.totals(squares, len(lines) + 1)
    return {g: (int(v[0]), v[1:]) for g, v in found.items()}
