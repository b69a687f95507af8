"""Elastic net from a correlation matrix, on the driver."""

from __future__ import annotations

import numpy as np

TOLERANCE = 1e-12


def sparse_weights(
    matrix: np.ndarray, target: np.ndarray, usable: np.ndarray, absolute: float, square: float, sweeps: int
) -> tuple[np.ndarray, float]:
    """Weights, and the largest violation of the optimality conditions among ``usable`` ones.

    Coordinate descent: each weight in turn takes its best value given the others. Sweeps run over
    the weights in use, with one over all of them in between. As soon as their signs suggest it,
    the linear system of the used weights is solved at once, which ends the search if its solution
    is optimal.
    """
    diagonal = np.diag(matrix)
    w, residual = np.zeros(len(target)), target.copy()

    def violation(w, residual) -> float:
        slope = residual - square * w
        used = w != 0
        off = np.where(used, np.abs(slope - absolute * np.sign(w)), np.abs(slope) - absolute)
        return float(off[usable].max(initial=0.0))

    def sweep(over) -> float:
        change = 0.0
        for j in over:
            pull = residual[j] + diagonal[j] * w[j]
            new = np.sign(pull) * max(abs(pull) - absolute, 0.0) / (diagonal[j] + square)
            step = new - w[j]
            if step:
                w[j] = new
                residual[:] -= step * matrix[j]
                change = max(change, abs(step))
        return change

    done = 0
    while done < sweeps:
        change = sweep(usable)
        done += 1
        used = np.flatnonzero(w)
        while len(used) and done < sweeps and change > 1e-3 * np.abs(w).max():
            change = sweep(used)
            done += 1
        exact = on_signs(matrix, target, np.sign(w), absolute, square)
        if exact is not None:
            left = target - matrix @ exact
            if violation(exact, left) <= TOLERANCE * max(1.0, absolute):
                w, residual = exact, left
                break
        if change <= TOLERANCE * max(np.abs(w).max(initial=0.0), 1e-300):
            break
    return w, max(violation(w, target - matrix @ w), 0.0)


def on_signs(matrix, target, signs, absolute: float, square: float) -> np.ndarray | None:
    """The weights that are optimal among those with these signs, if they have them."""
    used = np.flatnonzero(signs)
    system = matrix[np.ix_(used, used)] + square * np.eye(len(used))
    try:
        found = np.linalg.solve(system, target[used] - absolute * signs[used])
    except np.linalg.LinAlgError:
        return None
    if not np.isfinite(found).all() or (np.sign(found) != signs[used]).any():
        return None
    out = np.zeros(len(target))
    out[used] = found
    return out
