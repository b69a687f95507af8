"""Gradient descent by rows, several gradients from one scan.

The gradient of squared errors is Gw − b with G = XᵀX. A scan multiplies G with a block of
directions instead of one: as long as the gradients stay in the span of all directions so far,
updates need no further scan, since G times a gradient follows from the directions' images. Where
a gradient leaves the span, the part outside leads the next block, beside what G makes of the last
one. Up to ``DIRECTIONS`` features, one scan serves every update.

A last scan takes the errors before each update, and after the last, from the rows themselves.
"""

from __future__ import annotations

import numpy as np

from linefit.operators.iterative import Rows, errors_over

DIRECTIONS = 16
OUTSIDE = 1e-13


class Span:
    """An orthonormal basis with the images of its vectors under G."""

    def __init__(self, rows: Rows):
        self.rows, width = rows, rows.width
        random = np.random.default_rng(0)
        drawn = random.standard_normal((width, min(width, DIRECTIONS)))
        first = np.linalg.qr(drawn)[0]

        def function(z):
            x, y = z[:, :-1], z[:, -1]
            return np.concatenate([[len(z)], y @ x, (x.T @ (x @ first)).ravel()])

        (found,) = rows.totals(function, 1 + width * (1 + first.shape[1])).values()
        self.n, self.b = int(round(found[0])), found[1 : width + 1]
        self.basis, self.images = first, found[width + 1 :].reshape(width, -1)
        self.last = self.images
        self.random = random

    def outside(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):  # twice, as rounding asks for
            v = v - self.basis @ (self.basis.T @ v)
        return v

    def image(self, v: np.ndarray) -> np.ndarray:
        return self.images @ (self.basis.T @ v)

    def extend(self, lead: np.ndarray) -> None:
        """Take up ``lead`` and what the last block's images have outside of the span."""
        width = len(lead)
        room = min(DIRECTIONS, width - self.basis.shape[1])
        more = self.random.standard_normal((width, room))
        block = np.zeros((width, 0))
        for v in np.column_stack([lead, self.last, more]).T:
            size = np.linalg.norm(v)
            for _ in range(2):
                v = self.outside(v)
                v = v - block @ (block.T @ v)
            left = np.linalg.norm(v)
            if left > 1e-10 * size and block.shape[1] < room:
                block = np.column_stack([block, v / left])

        def function(z):
            x = z[:, :-1]
            return (x.T @ (x @ block)).ravel()

        (found,) = self.rows.totals(function, width * block.shape[1]).values()
        self.last = found.reshape(width, -1)
        self.basis = np.column_stack([self.basis, block])
        self.images = np.column_stack([self.images, self.last])


def path_of(rows: Rows, updates: int, step_size: float) -> list[np.ndarray]:
    """The weights before each update and after the last; shorter if they stop being finite."""
    span = Span(rows)
    w, g = np.zeros(rows.width), -span.b
    start = np.linalg.norm(g)
    path = [w]
    for i in range(updates):
        step = step_size / (span.n * np.sqrt(i + 1))
        with np.errstate(over="ignore", invalid="ignore"):
            if i + 1 < updates:
                outside = span.outside(g)
                while np.linalg.norm(outside) > OUTSIDE * max(start, np.linalg.norm(g)):
                    if span.basis.shape[1] == rows.width:
                        break
                    span.extend(outside)
                    outside = span.outside(g)
            w = w - step * g
            path.append(w)
            if not np.isfinite(w).all():
                break
            if i + 1 < updates:
                g = g - step * span.image(g)
    return path


def history_of(rows: Rows, path: list[np.ndarray]) -> np.ndarray:
    """Root mean squared errors of the weights on a path, from the rows."""
    with np.errstate(over="ignore", invalid="ignore"):
        (n, squares), = errors_over(rows, [(w, 0.0) for w in path if np.isfinite(w).all()]).values()
        return np.sqrt(squares / n)
