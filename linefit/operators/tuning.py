"""Cross-validated grid search for ridge regression in one scan.

Every fold's moments come from a single aggregate grouped by fold; a task contributes one
partial row per fold, so neither the number of folds nor a lopsided fold makes a hot spot.
Training statistics are the other folds' moments added up, the held-out error follows from
the fold's own, and the refit uses the sum of all.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
from pyspark import keyword_only
from pyspark.ml.base import Predictor
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.operators import iterative
from linefit.operators import moments as M
from linefit.operators.linear import RidgeModel, RidgePath, _Solver
from linefit.operators.split import fold_number


def parameter_grid(
    reg_params: Sequence[float], max_iters: Sequence[int]
) -> list[tuple[float, int]]:
    """All pairs, the first parameter varying slowest."""
    return list(product(reg_params, max_iters))


def grid_errors(
    folds: dict, grid: Sequence[tuple[float, int]]
) -> list[tuple[float, int, int, float]]:
    """Held-out error per grid entry and fold.

    ``maxIter`` does not change a direct solution: each strength is solved once per fold.
    """
    errors, _ = _errors_of(folds, fold_lines(folds, [reg for reg, _ in grid]))
    return _in_order(errors, grid, folds)


def fold_lines(folds: dict, strengths: Sequence[float]) -> dict:
    """(strength, fold) → weights and intercept fitted on the other folds."""
    if len(folds) < 2:
        raise ValueError("cross-validation needs rows in at least two folds")
    lines = {}
    for fold in folds:
        path = RidgePath(M.merge(m for f, m in folds.items() if f != fold))
        for strength in dict.fromkeys(strengths):
            lines[strength, fold] = path.solve(strength)
    return lines


def _errors_of(folds: dict, lines: dict) -> tuple[dict, bool]:
    """Held-out errors from the folds' sums, and whether those tell all of them well enough."""
    errors = {key: folds[key[1]].rmse(*line) for key, line in lines.items()}
    return errors, all(folds[key[1]].is_certain(line[0]) for key, line in lines.items())


def _in_order(errors: dict, grid, folds) -> list[tuple[float, int, int, float]]:
    return [(reg, it, fold, errors[reg, fold]) for reg, it in grid for fold in sorted(folds)]


def row_errors(df: DataFrame, lines: dict, by, label: str, features: str) -> dict:
    """Held-out errors of (key, fold) → (weights, intercept), row by row in one aggregate."""
    keys = list(lines)
    found = iterative.squared_errors(df, [lines[k] for k in keys], label, features, by)
    return {
        key: float(np.sqrt(found[key[1]][1][i] / found[key[1]][0])) for i, key in enumerate(keys)
    }


class RidgeGridModel(RidgeModel):
    """The winning model, refitted on all rows, with the table behind the choice."""

    def __init__(self, weights=(), intercept=0.0, train_rmse=float("nan"), errors=(), gap=0.0):
        super().__init__(weights, intercept, train_rmse, gap)
        self.errors = [tuple(e) for e in errors]

    def fold_table(self, spark: SparkSession) -> DataFrame:
        """``(regParam, maxIter, fold, rmse)`` for every grid entry and fold."""
        return spark.createDataFrame(
            self.errors, "regParam double, maxIter int, fold int, rmse double"
        )

    def mean_table(self, spark: SparkSession) -> DataFrame:
        """``(regParam, maxIter, rmse)``, the error averaged over the folds."""
        return (
            self.fold_table(spark)
            .groupBy("regParam", "maxIter")
            .agg(F.avg("rmse").alias("rmse"))
        )

    def best_table(self, spark: SparkSession) -> DataFrame:
        """The winner as one row ``(regParam, maxIter, train_rmse)``."""
        row = (self.getRegParam(), self.getMaxIter(), self.train_rmse)
        return spark.createDataFrame([row], "regParam double, maxIter int, train_rmse double")

    def _numbers(self):
        return {**super()._numbers(), "errors": [float(v) for e in self.errors for v in e]}

    def _restore(self, numbers):
        super()._restore(numbers)
        flat = numbers.get("errors", [])
        self.errors = [
            (flat[i], int(flat[i + 1]), int(flat[i + 2]), flat[i + 3])
            for i in range(0, len(flat), 4)
        ]


class RidgeGridSearch(Predictor, _Solver, DefaultParamsReadable, DefaultParamsWritable):
    """Fit with the grid entry of lowest mean held-out error; ties go to the earliest entry.

    Folds are the values of ``foldCol`` (0 … numFolds − 1) if set, else derived from ``keyCols``.
    Where the sums tell an error too poorly to choose by (a near-perfect fit), all errors are
    taken from the rows, in one more aggregate.
    """

    regParams = Param(Params._dummy(), "regParams", "strengths", TypeConverters.toListFloat)
    maxIters = Param(Params._dummy(), "maxIters", "iteration limits", TypeConverters.toListInt)
    numFolds = Param(Params._dummy(), "numFolds", "number of folds", TypeConverters.toInt)
    foldCol = Param(Params._dummy(), "foldCol", "integer fold column", TypeConverters.toString)
    keyCols = Param(Params._dummy(), "keyCols", "columns that make up the row key",
                    TypeConverters.toListString)
    seed = Param(Params._dummy(), "seed", "seed for folds from keys", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, labelCol="label", featuresCol="features", predictionCol="prediction",
        regParams=None, maxIters=None, numFolds=3, foldCol=None, keyCols=None, seed=0,
        solver="auto",
    ):
        super().__init__()
        self._setDefault(regParams=[0.0], maxIters=[100], numFolds=3, seed=0, solver="auto")
        self._set(**self._input_kwargs)

    def _fold(self):
        if self.isSet("foldCol"):
            fold = F.col(self.getOrDefault("foldCol")).cast("int")
            folds = self.getOrDefault("numFolds")
            outside = F.raise_error(F.lit(f"fold numbers must be in 0 … {folds - 1}"))
            return F.when(fold.between(0, folds - 1), fold).otherwise(outside)
        if not self.isSet("keyCols"):
            raise ValueError("set foldCol or keyCols")
        return fold_number(
            self.getOrDefault("keyCols"), self.getOrDefault("numFolds"), self.getOrDefault("seed")
        )

    def _fit(self, df: DataFrame) -> RidgeGridModel:
        label, features = self.getLabelCol(), self.getFeaturesCol()
        width = M.feature_width(df, features)
        if self.by_rows(width):
            return self.fit_rows(df, self._fold(), width)
        by = self._fold()
        folds = M.collect_moments(df, label, features, by=by, width=width)
        return self.fit_moments(folds, lambda lines: row_errors(df, lines, by, label, features))

    def _grid(self) -> list[tuple[float, int]]:
        return parameter_grid(self.getOrDefault("regParams"), self.getOrDefault("maxIters"))

    def _winner(self, errors: dict, folds) -> tuple[list, float, int]:
        grid = self._grid()
        table = _in_order(errors, grid, folds)
        means = [
            sum(e[3] for e in table[i * len(folds) : (i + 1) * len(folds)]) / len(folds)
            for i in range(len(grid))
        ]
        return table, *grid[means.index(min(means))]

    def fit_moments(self, folds: dict, from_rows=None) -> RidgeGridModel:
        """The model for folds already summed up.

        ``from_rows`` turns (strength, fold) → (weights, intercept) into errors row by row. It
        is asked only where the sums will not do; without it they have to.
        """
        lines = fold_lines(folds, self.getOrDefault("regParams"))
        errors, certain = _errors_of(folds, lines)
        if not certain and from_rows:
            errors = from_rows(lines)
        table, reg, iterations = self._winner(errors, folds)
        everything = M.merge(folds.values())
        weights, intercept = RidgePath(everything).solve(reg)
        error = everything.rmse(weights, intercept)
        if not everything.is_certain(weights) and from_rows:
            parts = from_rows({("all", f): (weights, intercept) for f in folds})
            squares = sum(m.n * parts["all", f] ** 2 for f, m in folds.items())
            error = float(np.sqrt(squares / everything.n))
        model = RidgeGridModel(weights, intercept, error, table)
        return model._columns_from(self)._set(regParam=reg, maxIter=iterations)

    def fit_rows(self, df: DataFrame, by, width: int) -> RidgeGridModel:
        """The same from the rows, staged once: each fold's strengths, and those of all rows for
        the winner, follow from one vector that goes through the rows per iteration."""
        label, features = self.getLabelCol(), self.getFeaturesCol()
        strengths = list(dict.fromkeys(self.getOrDefault("regParams")))
        limit = max(1000, *self.getOrDefault("maxIters"))
        with iterative.BlockRows(df, label, features, by, width) as rows:
            folds = [r["group"] for r in rows.blocks.where("n > 0").select("group").distinct().collect()]
            if len(folds) < 2:
                raise ValueError("cross-validation needs rows in at least two folds")
            solved = iterative.solve_shifted(rows, strengths, [*sorted(folds), None], limit)
            keys = list(solved)
            found = iterative.errors_over(rows, [(solved[k].weights, solved[k].intercept) for k in keys])
        squares = {k: {f: (n, e[i]) for f, (n, e) in found.items()} for i, k in enumerate(keys)}
        errors = {
            (s, f): float(np.sqrt(squares[s, f][f][1] / squares[s, f][f][0])) for s, f in keys if f is not None
        }
        table, reg, iterations = self._winner(errors, folds)
        final, parts = solved[reg, None], squares[reg, None].values()
        error = float(np.sqrt(sum(e for _, e in parts) / sum(n for n, _ in parts)))
        model = RidgeGridModel(final.weights, final.intercept, error, table, final.gap)
        return model._columns_from(self)._set(regParam=reg, maxIter=iterations)
