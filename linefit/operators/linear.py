"""Linear regression: batch gradient descent and ridge, from one pass over the rows."""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml.base import PredictionModel, Predictor
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.functions import vectors as V
from linefit.functions.once import computed_once
from linefit.operators import consensus, descent, iterative, sketch
from linefit.operators import moments as M
from linefit.operators.coordinates import sparse_weights
from linefit.operators.summary import vector_sum


class LinearModel(PredictionModel, MLWritable, MLReadable):
    """Weights and intercept; scoring is a native expression with the weights as literals."""

    def __init__(self, weights=(), intercept: float = 0.0):
        super().__init__()
        self.weights = np.asarray(weights, dtype=float)
        self.intercept = float(intercept)

    @property
    def numFeatures(self) -> int:
        return len(self.weights)

    def predict(self, value) -> float:
        """Prediction for one vector, on the driver; tables go through ``transform``."""
        x = np.asarray(value.toArray() if hasattr(value, "toArray") else value, dtype=float)
        if x.shape != self.weights.shape:
            raise ValueError(f"vector widths differ: {len(x)} and {self.numFeatures}")
        return float(x @ self.weights + self.intercept)

    def _transform(self, df: DataFrame) -> DataFrame:
        name = self.getFeaturesCol()
        known = V.known_width(df, name)
        if known is not None and known != self.numFeatures:
            raise ValueError(f"vector widths differ: {known} and {self.numFeatures}")
        score = V.dot_weights(V.as_array(df, name), self.weights)
        if self.intercept:
            score = score + F.lit(self.intercept)
        return df.withColumn(self.getPredictionCol(), score)

    def weights_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, float(w)) for i, w in enumerate(self.weights)]
        return spark.createDataFrame(rows, "idx int, value double")

    def _numbers(self) -> dict[str, list[float]]:
        """What has to be saved besides the params, as named lists of numbers."""
        return {"weights": self.weights.tolist(), "intercept": [self.intercept]}

    def _restore(self, numbers: dict[str, list[float]]) -> None:
        self.weights = np.array(numbers.get("weights", []), dtype=float)
        self.intercept = numbers["intercept"][0]

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader(cls)

    def _columns_from(self, estimator) -> LinearModel:
        return estimator._copyValues(self)


class _ModelWriter(MLWriter):
    """Params as Spark's own metadata, numbers as a parquet table ``(name, idx, value)``."""

    def __init__(self, model: LinearModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        rows = [
            (name, i, float(v))
            for name, values in self.model._numbers().items()
            for i, v in enumerate(values)
        ]
        spark.createDataFrame(rows, "name string, idx int, value double").coalesce(
            1
        ).write.parquet(f"{path}/numbers")


class _ModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        numbers: dict[str, list[float]] = {}
        table = self.sparkSession.read.parquet(f"{path}/numbers").orderBy("name", "idx")
        for row in table.collect():  # as many rows as the model has numbers
            numbers.setdefault(row["name"], []).append(row["value"])
        model._restore(numbers)
        return model


class _Solver(Params):
    """How the rows are read: their moments once, or one aggregate per iteration."""

    #: Further ways by rows that an estimator has besides ``rows``.
    WAYS: tuple[str, ...] = ()

    solver = Param(
        Params._dummy(), "solver",
        f"moments, rows, or auto: moments up to {M.WIDE} features, where the matrix of products "
        "is smaller than the data of a task, and by rows beyond; all give the same answer. By rows "
        "ridge can be sketched, and the elastic net found by consensus",
        TypeConverters.toString,
    )

    def by_rows(self, width: int) -> bool:
        chosen = self.getOrDefault("solver")
        known = ("auto", "moments", "rows", *self.WAYS)
        if chosen not in known:
            raise ValueError(f"solver is one of {', '.join(known)}, not {chosen!r}")
        return chosen not in ("auto", "moments") or chosen == "auto" and width > M.WIDE

    def way(self, width: int) -> str:
        """How rows are read where they are: as asked for, or as suits the width."""
        chosen = self.getOrDefault("solver")
        if chosen != "auto":
            return chosen
        if "sketched" in self.WAYS:
            return "sketched" if width <= sketch.WIDEST else "rows"
        return self.WAYS[0] if self.WAYS else "rows"


# --- gradient descent ---------------------------------------------------------------------


def residual(weights, label: str = "label", features: str = "features") -> Column:
    """w·x − y for each row."""
    return V.dot_weights(F.col(features), weights) - F.col(label)


def gradient_terms(
    df: DataFrame, weights, label: str = "label", features: str = "features"
) -> DataFrame:
    """Add ``gradient_term``, each row's part (w·x − y)·x of the gradient."""
    # A function over the elements would compute the residual anew for each of them.
    rows = computed_once(df, {"_residual": residual(weights, label, features)})
    term = V.scale(F.col(features), F.col("_residual"))
    width = len(weights)
    named = term.alias("gradient_term", metadata=V.width_metadata(width))
    return rows.withColumn("gradient_term", named).drop("_residual")


def gradient(
    df: DataFrame, weights, label: str = "label", features: str = "features"
) -> DataFrame:
    """Full-batch gradient as rows ``(idx, value)``."""
    return vector_sum(gradient_terms(df, weights, label, features), "gradient_term")


class GradientDescentModel(LinearModel):
    """``history[i]`` is the training error before update i; ``final_rmse`` after the last."""

    def __init__(self, weights=(), history=(), final_rmse: float = float("nan")):
        super().__init__(weights)
        self.history = [float(h) for h in history]
        self.final_rmse = float(final_rmse)

    def history_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.history)), "iter int, rmse double")

    def _numbers(self):
        return {
            **super()._numbers(), "history": self.history, "final_rmse": [self.final_rmse],
        }

    def _restore(self, numbers):
        super()._restore(numbers)
        self.history = numbers.get("history", [])
        self.final_rmse = numbers["final_rmse"][0]


class GradientDescentRegression(Predictor, _Solver, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares without intercept by full-batch gradient descent.

    The weights start at zero; update i subtracts stepSize / (n·sqrt(i + 1)) times the
    gradient. By moments all updates follow from one aggregate over the rows, and errors that
    those do not tell well enough are taken from the rows in a second one; by rows, they are
    written to the shared folder for the time of the fit and a scan serves several updates
    (:mod:`descent`).
    """

    numIterations = Param(
        Params._dummy(), "numIterations", "number of updates", TypeConverters.toInt
    )
    stepSize = Param(Params._dummy(), "stepSize", "size of the first step", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, labelCol="label", featuresCol="features", predictionCol="prediction",
        numIterations=100, stepSize=1.0, solver="auto",
    ):
        super().__init__()
        self._setDefault(numIterations=100, stepSize=1.0, solver="auto")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> GradientDescentModel:
        label, features = self.getLabelCol(), self.getFeaturesCol()
        width = M.feature_width(df, features)
        if not self.by_rows(width):
            rows = M.collect_moments(df, label, features, width=width)[None]
            return self.fit_moments(rows, df)
        with iterative.BlockRows(df, label, features, None, width) as rows:
            path = descent.path_of(rows, self.getOrDefault("numIterations"), self.getOrDefault("stepSize"))
            history = descent.history_of(rows, path)
        finite = int(np.isfinite(history).sum())
        if finite < self.getOrDefault("numIterations") + 1:
            raise _diverged(finite - 1)
        *history, final = history.tolist()
        return GradientDescentModel(path[-1], history, final)._columns_from(self)

    def fit_moments(self, rows: M.Moments, df: DataFrame | None = None) -> GradientDescentModel:
        """The model for rows already summed up.

        Where the sums do not tell an error well enough (a near-perfect fit), all errors are taken
        from ``df``, the rows themselves, in one pass; without it they are the sums' best.
        """
        path: list = []
        model = self._descend(_loss_of(rows), rows.width, path)
        if df is not None and not all(rows.is_certain(w) for w in path):
            lines = [(w, 0.0) for w in path]
            found = iterative.squared_errors(df, lines, self.getLabelCol(), self.getFeaturesCol())
            (n, squares), = found.values()
            *model.history, model.final_rmse = np.sqrt(squares / n).tolist()
        return model

    def _descend(self, loss, width: int, path: list | None = None) -> GradientDescentModel:
        """``path`` receives the weights before each update and after the last."""
        weights, history = np.zeros(width), []
        n, error, g = loss(weights)
        for i in range(self.getOrDefault("numIterations")):
            history.append(error)
            if path is not None:
                path.append(weights)
            with np.errstate(over="ignore", invalid="ignore"):
                weights = weights - self.getOrDefault("stepSize") / (n * np.sqrt(i + 1)) * g
                if np.isfinite(weights).all():
                    n, error, g = loss(weights)
            if not (np.isfinite(weights).all() and np.isfinite(error)):
                raise _diverged(i)
        if path is not None:
            path.append(weights)
        return GradientDescentModel(weights, history, error)._columns_from(self)


def _diverged(update: int) -> ArithmeticError:
    return ArithmeticError(
        f"gradient descent diverged at update {update}: scale the features into [0, 1] "
        "or take a smaller stepSize"
    )


def _loss_of(rows: M.Moments):
    """Count, error and gradient for weights, from sums."""
    return lambda w: (rows.n, rows.rmse(w), rows.gradient(w))


# --- ridge and elastic net ----------------------------------------------------------------

SWEEPS = 10_000


class RidgePath:
    """Ridge and elastic-net solutions for any strength from one set of moments.

    Features and label are standardised, the strength is taken in units of the label's
    deviation and the intercept is free, as in MLlib's normal-equation solver. One
    eigendecomposition serves every ridge strength.
    """

    def __init__(self, rows: M.Moments):
        self.mean = rows.mean
        variance = np.diag(rows.products) / rows.n
        variance = np.where(variance <= (1e-14 * rows.mean) ** 2, 0.0, variance)
        deviation = np.sqrt(variance)
        inverse = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
        correlation = rows.products / rows.n * np.outer(inverse, inverse)
        self.deviation, self.inverse = deviation, inverse
        self.correlation = correlation
        self.values, self.basis = np.linalg.eigh(correlation[:-1, :-1])
        self.along = self.basis.T @ correlation[:-1, -1]

    def solve(
        self, strength: float, l1_share: float = 0.0, sweeps: int = SWEEPS
    ) -> tuple[np.ndarray, float]:
        """Weights and intercept; a constant feature or label gets weight zero.

        ``gap`` then tells how far the last solution is from an optimal one.
        """
        self.gap = 0.0
        if self.deviation[-1] == 0.0:
            return np.zeros(len(self.values)), float(self.mean[-1])
        relative = strength / self.deviation[-1]
        scaled = self._sparse(relative, l1_share, sweeps) if l1_share else self._ridge(relative)
        weights = scaled * self.deviation[-1] * self.inverse[:-1]
        return weights, float(self.mean[-1] - weights @ self.mean[:-1])

    def _ridge(self, strength: float) -> np.ndarray:
        shifted = self.values + strength
        usable = shifted > 1e-12 * max(shifted.max(initial=0.0), 1e-300)
        along = np.divide(self.along, shifted, out=np.zeros_like(shifted), where=usable)
        return self.basis @ along

    def _sparse(self, strength: float, l1_share: float, sweeps: int) -> np.ndarray:
        matrix, target = self.correlation[:-1, :-1], self.correlation[:-1, -1]
        usable = np.flatnonzero(self.inverse[:-1])
        w, self.gap = sparse_weights(
            matrix, target, usable, strength * l1_share, strength * (1 - l1_share), sweeps
        )
        return w


class _RidgeParams(Params):
    regParam = Param(Params._dummy(), "regParam", "ridge strength", TypeConverters.toFloat)
    maxIter = Param(
        Params._dummy(), "maxIter",
        "most iterations; a ridge solution from moments takes none and ignores it",
        TypeConverters.toInt,
    )

    def getRegParam(self) -> float:
        return self.getOrDefault("regParam")

    def getMaxIter(self) -> int:
        return self.getOrDefault("maxIter")


class RidgeModel(LinearModel, _RidgeParams):
    """Fitted ridge regression with its training error.

    ``gap`` is the largest violation of the optimality conditions, in standard units: zero for
    a direct solution, more than rounding only where ``maxIter`` ended the search.
    """

    def __init__(
        self, weights=(), intercept=0.0, train_rmse: float = float("nan"), gap: float = 0.0
    ):
        super().__init__(weights, intercept)
        self._setDefault(regParam=0.0, maxIter=100)
        self.train_rmse, self.gap = float(train_rmse), float(gap)

    def _numbers(self):
        return {**super()._numbers(), "train_rmse": [self.train_rmse], "gap": [self.gap]}

    def _restore(self, numbers):
        super()._restore(numbers)
        self.train_rmse = numbers["train_rmse"][0]
        self.gap = numbers.get("gap", [0.0])[0]


class RidgeRegression(
    Predictor, _RidgeParams, _Solver, DefaultParamsReadable, DefaultParamsWritable
):
    """Ridge regression (ordinary least squares at strength 0) from one aggregate.

    By rows, one aggregate per iteration: ``maxIter`` of them at most. ``sketched``, the default
    up to a width of ``sketch.WIDEST``, takes about 20 however ill-conditioned the features are.
    """

    WAYS = ("sketched",)

    @keyword_only
    def __init__(
        self, *, labelCol="label", featuresCol="features", predictionCol="prediction",
        regParam=0.0, maxIter=100, solver="auto",
    ):
        super().__init__()
        self._setDefault(regParam=0.0, maxIter=100, solver="auto")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> RidgeModel:
        label, features = self.getLabelCol(), self.getFeaturesCol()
        width = M.feature_width(df, features)
        if self.by_rows(width):
            with iterative.BlockRows(df, label, features, None, width) as blocks:
                found = self._by_rows(blocks, self.way(width))
                line = [(found.weights, found.intercept)]
                (n, squares), = iterative.errors_over(blocks, line).values()
            model = RidgeModel(*line[0], float(np.sqrt(squares[0] / n)), found.gap)
            return model._columns_from(self)
        rows = M.collect_moments(df, label, features, width=width)[None]
        weights, intercept, gap = self._solved(rows)
        if rows.is_certain(weights):
            error = rows.rmse(weights, intercept)
        else:
            line = [(weights, intercept)]
            (n, squares), = iterative.squared_errors(df, line, label, features).values()
            error = float(np.sqrt(squares[0] / n))
        return RidgeModel(weights, intercept, error, gap)._columns_from(self)

    def _by_rows(self, rows: iterative.BlockRows, way: str) -> iterative.Solution:
        if way == "sketched":
            return sketch.solve(rows, self.getRegParam(), self.getMaxIter())
        model = iterative.Model(self.getRegParam(), self._l1_share())
        return iterative.Problem(rows, [model]).solve(self.getMaxIter())[0]

    def fit_moments(self, rows: M.Moments) -> RidgeModel:
        """The model for rows already summed up, without another pass.

        ``train_rmse`` is NaN where the sums do not tell it well enough.
        """
        weights, intercept, gap = self._solved(rows)
        error = rows.rmse(weights, intercept) if rows.is_certain(weights) else float("nan")
        return RidgeModel(weights, intercept, error, gap)._columns_from(self)

    def _solved(self, rows: M.Moments) -> tuple[np.ndarray, float, float]:
        path = RidgePath(rows)
        weights, intercept = path.solve(self.getRegParam(), self._l1_share(), self.getMaxIter())
        return weights, intercept, path.gap

    def _l1_share(self) -> float:
        return 0.0


class ElasticNetRegression(RidgeRegression):
    """Elastic net from one aggregate, solved until the weights settle.

    ``maxIter`` limits the sweeps over the weights (by rows, the proximal steps); a model that
    it has stopped short says so by its ``gap``. MLlib's steps are other ones; they lead to the
    same weights where their limit lets them. ``consensus``, the default beyond ``moments``, reads
    factors of the rows in place of the rows.
    """

    WAYS = ("consensus",)

    elasticNetParam = Param(
        Params._dummy(), "elasticNetParam", "share of the absolute penalty",
        TypeConverters.toFloat,
    )

    @keyword_only
    def __init__(
        self, *, labelCol="label", featuresCol="features", predictionCol="prediction",
        regParam=0.0, elasticNetParam=0.0, maxIter=SWEEPS, solver="auto",
    ):
        kwargs = self._input_kwargs
        super().__init__()
        self._setDefault(elasticNetParam=0.0, maxIter=SWEEPS)
        self._set(**kwargs)

    def _l1_share(self) -> float:
        return self.getOrDefault("elasticNetParam")

    def _by_rows(self, rows: iterative.BlockRows, way: str) -> iterative.Solution:
        if way == "consensus":
            return consensus.solve(rows, self.getRegParam(), self._l1_share(), self.getMaxIter())
        return super()._by_rows(rows, way)
