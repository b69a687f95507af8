"""Wide ridge by sketch and precondition.

One pass adds every row, with random signs, to ``SPREAD`` of 4 to 16 × width hashed places. Tasks
add up each other's sums and take the triangular factor of this sketch, a few places at a time. It
makes the system's directions
about equally long whatever its condition, and conjugate gradients on the normal equations (whose
iterates are those of LSQR) settle in a number of scans that does not depend on it. Every scan
reads the staged rows with one vector. Residuals are taken anew from the rows at the end, and the
search goes on from there if they do not hold.

A task holds the sketch in single precision, ``NUMBERS`` numbers or 4 × width², which sets
``WIDEST``; the driver receives the triangle alone, of width² numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from linefit.operators.iterative import BlockRows, Model, Problem, Solution

NUMBERS = 16_000_000
SPREAD = 4
WIDEST = 3000
SETTLED = 1e-12
LEAST = 1e-13
PIECE = 128
BANDS = "band int, rows binary"


def _sketcher(center: np.ndarray, inverse: np.ndarray, places: int):
    """Bands of ``PIECE`` places: sums over the blocks of a task, in single precision."""
    d = len(center)

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((places, d), np.float32)
        touched = np.zeros(places, bool)
        for batch in batches:
            for block, rows in zip(batch.column("block").to_pylist(), batch.column("rows")):
                x = np.frombuffer(rows.as_buffer()).reshape(-1, d + 1)[:, :-1]
                x = (x - center) * inverse
                random = np.random.default_rng(block)  # a block is drawn for alike in every run
                for _ in range(SPREAD):
                    place = random.integers(0, places, len(x))
                    signed = x * random.choice([-1.0, 1.0], len(x))[:, None]
                    order = np.argsort(place, kind="stable")
                    at, first = np.unique(place[order], return_index=True)
                    sums[at] += np.add.reduceat(signed[order], first, axis=0).astype(np.float32)
                    touched[at] = True
        for band in np.unique(np.flatnonzero(touched) // PIECE).tolist():
            rows = sums[band * PIECE : (band + 1) * PIECE].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([band], pa.int32()), pa.array([rows])], ["band", "rows"])

    return sketched


def _folder(d: int, add: bool, root: float = 0.0):
    """The triangle of all rows of a task's bands and of ``root`` times the identity, as bands of
    doubles. With ``add``, bands are sums in single precision, and those of one number are added."""

    fold_rows = max(1, d // 2)  # more at a time would be quicker, but need more memory

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle = root * np.eye(d) if root else np.empty((0, d))
        held, sums = [], {}

        def bands():
            for batch in batches:
                for band, rows in zip(batch.column("band").to_pylist(), batch.column("rows")):
                    if not add:
                        yield np.frombuffer(rows.as_buffer()).reshape(-1, d)
                    elif band in sums:
                        sums[band] += np.frombuffer(rows.as_buffer(), np.float32).reshape(-1, d)
                    else:
                        sums[band] = np.frombuffer(rows.as_buffer(), np.float32).reshape(-1, d).copy()
            for band in sorted(sums):
                yield sums.pop(band)

        def fold():
            nonlocal triangle
            matrix = np.empty((len(triangle) + sum(map(len, held)), d))
            matrix[: len(triangle)] = triangle
            at, triangle = len(triangle), None  # each array goes before the next is made
            while held:
                rows = held.pop(0)
                matrix[at : at + len(rows)] = rows
                at += len(rows)
            triangle = np.linalg.qr(matrix, mode="r")

        for rows in bands():
            held.append(rows)
            if sum(map(len, held)) >= fold_rows:
                fold()
        if held:
            fold()
        for band in range(-(-len(triangle) // PIECE)):
            rows = triangle[band * PIECE : (band + 1) * PIECE].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([band], pa.int32()), pa.array([rows])], ["band", "rows"])

    return folded


def triangle_of(problem: Problem, strength: float) -> np.ndarray:
    """The triangle of the sketch above the root of ``strength``.

    A sketching task takes at least as many rows as there are places, as far as there are so many,
    so that sketches are smaller than the rows.
    """
    rows, n = problem.rows, float(problem.n[0])
    d = rows.width
    places = int(np.clip(NUMBERS // d, 4 * d, 16 * d))
    center, inverse = (rows.origin + problem.mean[0])[:-1], problem.inverse[0, :-1]
    scale = np.sqrt(SPREAD * n)
    table = (
        rows.blocks.where("n > 0").select("block", "rows").coalesce(max(1, int(n / places)))
        .mapInArrow(_sketcher(center, inverse, places), BANDS)
        .repartition(places // (2 * d), "band").mapInArrow(_folder(d, True), BANDS)
        .repartition(1).mapInArrow(_folder(d, False, scale * np.sqrt(strength)), BANDS)
    ).toArrow()
    order = np.argsort(table.column("band").to_numpy())
    bands = [table.column("rows")[int(i)].as_buffer() for i in order]
    return np.concatenate([np.frombuffer(b).reshape(-1, d) for b in bands]) / scale


def preconditioner(problem: Problem, strength: float) -> np.ndarray:
    """A matrix P so that P Pᵀ is about the inverse of the system's matrix: the inverse of the
    triangle of the sketch above the root of ``strength``, without directions of no length."""
    triangle = triangle_of(problem, strength)
    size = np.abs(np.diag(triangle))
    if len(triangle) == len(triangle.T) and size.min() > LEAST * size.max():
        return np.linalg.inv(triangle)
    _, lengths, directions = np.linalg.svd(triangle, full_matrices=False)
    usable = lengths > LEAST * lengths.max()
    return directions[usable].T / lengths[usable]


def solve(rows: BlockRows, strength: float, max_iter: int) -> Solution:
    """Ridge over staged rows; ``gap`` as that of :mod:`iterative`."""
    problem = Problem(rows, [Model(strength)])
    relative = strength * problem.inverse[0, -1]
    p = preconditioner(problem, relative)

    def slope(w, with_label=False):
        return problem.products(w[None], with_label)[0] + relative * w

    def preconditioned(v):
        return p @ (p.T @ v)

    w = np.zeros(rows.width)
    residual = -slope(w, with_label=True)
    start = np.sqrt(max(residual @ preconditioned(residual), 0.0))
    scans, gap = 1, np.abs(residual).max(initial=0.0)
    while scans < max_iter and start > 0:
        z = preconditioned(residual)
        direction, size = z, residual @ z
        while scans < max_iter and np.sqrt(max(size, 0.0)) > SETTLED * start:
            image = slope(direction)
            scans += 1
            along = direction @ image
            if along <= 0:
                break
            step = size / along
            w, residual = w + step * direction, residual - step * image
            z = preconditioned(residual)
            new = residual @ z
            direction, size = z + new / size * direction, new
        residual = -slope(w, with_label=True)
        scans += 1
        before, gap = gap, np.abs(residual).max(initial=0.0)
        left = np.sqrt(max(residual @ preconditioned(residual), 0.0))
        if left <= 1e3 * SETTLED * start or gap > 0.5 * before:
            break
    (found,) = problem.solutions(w[None], np.array([gap]))
    return found
