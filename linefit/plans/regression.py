"""Feature preparation and the regression programs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefit.functions import fields as X
from linefit.functions.once import computed_once
from linefit.operators import stages as S
from linefit.operators.evaluate import rmse_table
from linefit.operators.linear import (
    ElasticNetRegression,
    GradientDescentModel,
    GradientDescentRegression,
    LinearModel,
    RidgeModel,
)
from linefit.operators.moments import (
    Moments,
    collect_moments,
    feature_width,
    finite_rows,
    merge,
)
from linefit.operators.split import fold_number, hash_split, with_part
from linefit.operators.tuning import RidgeGridModel, RidgeGridSearch, row_errors
from linefit.plans import fixed_values as K
from linefit.sources.delimited import CORRUPT, parsed
from linefit.sources.memory import from_rows
from linefit.sources.text import BAD_NUMBER, NON_FINITE, REASON, WIDTH

Shift = S.LabelShift | S.MinimumLabelShift


def number_stages(
    source: str, positions: Sequence[int] = tuple(K.FEATURE_FIELDS), shift: Shift | None = None
) -> list:
    """Numbers in ``source`` → ``label`` (shifted) and ``features``."""
    shift = shift or S.LabelShift(offset=float(K.FIRST_YEAR))
    return [
        S.VectorPicker(inputCol=source, outputCol="year_vector", indices=[K.LABEL_FIELD]),
        S.FirstElement(inputCol="year_vector", outputCol="year"),
        shift.copy()._set(inputCol="year", outputCol="label"),
        S.VectorPicker(inputCol=source, outputCol="features", indices=list(positions)),
    ]


def text_stages(
    source: str, positions: Sequence[int] = tuple(K.FEATURE_FIELDS), shift: Shift | None = None
) -> list:
    """Array of texts in ``source`` → ``label`` and ``features``.

    Only the fields in use are read as numbers.
    """
    used = [K.LABEL_FIELD, *positions]
    return [
        S.ToNumbers(inputCol=source, outputCol="numbers", indices=used),
        *number_stages("numbers", range(1, len(used)), shift),
    ]


def line_stages(shift: Shift | None = None, tokenize: bool = False) -> list:
    """Line in ``value`` → ``label`` and ``features``.

    Fields keep their position unless ``tokenize`` asks for the tokenizer, which closes the
    gap an empty field leaves.
    """
    if tokenize:
        first = S.LineTokenizer(inputCol="value", outputCol="texts")
    else:
        needed = max(K.LABEL_FIELD, *K.FEATURE_FIELDS) + 1
        first = S.FieldSplitter(inputCol="value", outputCol="texts", first=needed)
    return [first, *text_stages("texts", shift=shift)]


def prepare_lines(lines: DataFrame, tokenize: bool = False) -> PipelineModel:
    """Fitted preparation with the label's own minimum as offset."""
    return Pipeline(stages=line_stages(S.MinimumLabelShift(), tokenize)).fit(lines)


def prepared(df: DataFrame, stages: Sequence) -> DataFrame:
    """Apply stages that need no fitting."""
    return PipelineModel(list(stages)).transform(df)


# --- programs: fitted model and table of errors -------------------------------------------


def _errors(model, df: DataFrame, weights, keys, seed) -> DataFrame:
    """Error on the training part and on the test part, in one pass over both."""
    side = F.when(F.col("part") == 0, "train").otherwise("test")
    scored = model.transform(with_part(df, weights, keys, seed)).withColumn("side", side)
    return rmse_table(scored, by=["side"])


# ``keys`` tell rows apart for the split; None draws every row by itself (see ``split``).


def test_rows(df: DataFrame, weights, keys: Sequence[str] | None, seed: int) -> DataFrame:
    """The rows a program does not train on."""
    return with_part(df, weights, keys, seed).filter(F.col("part") > 0).drop("part")


def _fitted_by_rows(estimator, df, weights, keys, seed):
    """Fit on the training part and errors on both, by passes over the rows."""
    train, *_ = hash_split(df, weights, keys, seed)
    model = estimator.fit(train)
    return model, _errors(model, df, weights, keys, seed)


def elastic_net(
    df: DataFrame, keys: Sequence[str] | None, weights=tuple(K.SPLIT_7_3), seed: int = 0,
    solver: str = "auto",
) -> tuple[RidgeModel, DataFrame]:
    """Elastic net on the training part and error on both parts, by moments in one scan."""
    estimator = ElasticNetRegression(**K.ELASTIC_NET, solver=solver)
    width = feature_width(df, "features")
    if estimator.by_rows(width):
        return _fitted_by_rows(estimator, df, weights, keys, seed)
    sides = _sides(df, keys, weights, seed, width)
    model = estimator.fit_moments(sides["train"])
    return model, _errors_from_moments(model, sides, df, weights, keys, seed)


def elastic_net_by_mllib(
    df: DataFrame, keys: Sequence[str], weights=tuple(K.SPLIT_7_3), seed: int = 0,
    max_iter: int = K.ELASTIC_NET_ITERATIONS,
) -> tuple[PipelineModel, DataFrame]:
    """The same by MLlib's solver, for whoever needs the weights after exactly ``max_iter``
    of its steps; fit and errors are a pass each."""
    regression = LinearRegression(
        featuresCol="vector", maxIter=max_iter, **K.ELASTIC_NET
    )
    to_vector = S.ToMLVector(inputCol="features", outputCol="vector")
    train, _ = hash_split(df, weights, keys, seed)
    model = Pipeline(stages=[to_vector, regression]).fit(train)
    return model, _errors(model, df, weights, keys, seed)


def _sides(df: DataFrame, keys, weights, seed, width: int | None = None) -> dict[str, Moments]:
    """Moments of the training and the test part, from one scan."""
    parted = with_part(df, weights, keys, seed)
    groups = collect_moments(parted, by=F.col("part"), width=width)
    if 0 not in groups:
        raise ValueError("no rows to fit on")
    return {name: groups[g] for g, name in ((0, "train"), (1, "test")) if g in groups}


def _errors_from_moments(
    model: LinearModel, sides: dict[str, Moments], df: DataFrame, weights, keys, seed
) -> DataFrame:
    """The same table without another pass, where the sums tell the errors well enough."""
    if not all(rows.is_certain(model.weights) for rows in sides.values()):
        return _errors(model, df, weights, keys, seed)
    return from_rows(
        df.sparkSession,
        [(s, "rmse", m.rmse(model.weights, model.intercept)) for s, m in sides.items()],
        "side string, metric string, value double",
    )


def tuned_ridge(
    df: DataFrame, keys: Sequence[str] | None, seed: int = K.TUNING_SEED,
    features: str = "features", solver: str = "auto",
) -> tuple[RidgeGridModel, DataFrame]:
    """Grid search over strength and iteration limit, refitted on all training rows.

    By moments one scan serves folds, refit and both errors: they are taken per part and fold.
    """
    search = RidgeGridSearch(
        featuresCol=features, regParams=K.REG_PARAMS, maxIters=K.MAX_ITERS, numFolds=K.FOLDS,
        solver=solver,
    )
    part, fold = F.col("part"), fold_number(keys, K.FOLDS, seed)
    parted, width = with_part(df, K.SPLIT_9_1, keys, seed), feature_width(df, features)
    train = parted.filter(part == 0)
    if search.by_rows(width):
        model = search.fit_rows(train, fold, width)
        return model, _errors(model, df, K.SPLIT_9_1, keys, seed)
    groups = collect_moments(parted, features=features, by=part * K.FOLDS + fold, width=width)
    folds = {g: m for g, m in groups.items() if g < K.FOLDS}
    model = search.fit_moments(
        folds, lambda lines: row_errors(train, lines, fold, "label", features)
    )
    sides = {"train": merge(folds.values())}
    tested = [m for g, m in groups.items() if g >= K.FOLDS]
    if tested:
        sides["test"] = merge(tested)
    return model, _errors_from_moments(model, sides, df, K.SPLIT_9_1, keys, seed)


def tuned_degree_two_ridge(
    df: DataFrame, keys: Sequence[str] | None, seed: int = K.TUNING_SEED, solver: str = "auto"
) -> tuple[RidgeGridModel, DataFrame]:
    """The same over all products of two features."""
    return tuned_ridge(with_products(df), keys, seed, features="products", solver=solver)


def with_products(df: DataFrame) -> DataFrame:
    return S.DegreeTwo(inputCol="features", outputCol="products").transform(df)


def gradient_descent(
    df: DataFrame, keys: Sequence[str] | None, seed: int = 0, solver: str = "auto"
) -> tuple[GradientDescentModel, DataFrame]:
    """Fit on the training part and error on both, by moments in one scan."""
    estimator = GradientDescentRegression(numIterations=K.GRADIENT_ITERATIONS, solver=solver)
    width = feature_width(df, "features")
    if estimator.by_rows(width):
        return _fitted_by_rows(estimator, df, K.SPLIT_9_1, keys, seed)
    sides = _sides(df, keys, K.SPLIT_9_1, seed, width)
    train, _ = hash_split(df, K.SPLIT_9_1, keys, seed)
    model = estimator.fit_moments(sides["train"], train)
    return model, _errors_from_moments(model, sides, df, K.SPLIT_9_1, keys, seed)


# --- wide CSV -----------------------------------------------------------------------------


def packed_songs(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Wide text records → ``values``, the needed columns of songs with a known year.

    The year is compared as a number, before the columns are packed away.
    """
    known = records.filter(X.to_double(F.col("Year")) > 0)
    kept = [F.col(k).alias(f"kept_{k}") for k in keep]  # by another name, so drop spares them
    narrow = known.select(*kept, *K.CSV_COLUMNS).drop(*K.CSV_DROPPED)
    return narrow.select(
        *[F.col(f"kept_{k}").alias(k) for k in keep], F.array(*K.CSV_PACKED).alias("values")
    )


def _packed_numbers(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    numbers = F.array(*[X.to_double(F.get("values", F.lit(i))) for i in range(len(K.CSV_PACKED))])
    return computed_once(packed_songs(records, keep), {"numbers": numbers})


def wide_csv_rejects(checked: DataFrame) -> DataFrame:
    """``(reason, count)`` of the records that :func:`wide_csv_regression` leaves out though
    their year is known, from records with ``delimited.CORRUPT``."""
    corrupt = F.col(CORRUPT).isNotNull()
    good = _packed_numbers(checked.filter(~corrupt))
    fields = [F.get("numbers", F.lit(i)) for i in range(len(K.CSV_PACKED))]
    missing = reduce(or_, [f.isNull() for f in fields])
    odd = reduce(or_, [~(f * 0.0 == 0.0) for f in fields])
    reason = F.when(missing, BAD_NUMBER).when(odd, NON_FINITE)
    return (
        checked.filter(corrupt & parsed(checked)).select(F.lit(WIDTH).alias(REASON))
        .unionByName(good.select(reason.alias(REASON)))
        .filter(F.col(REASON).isNotNull()).groupBy(REASON).agg(F.count("*").alias("count"))
    )


def wide_csv_rows(records: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Wide text records → ``label`` and ``features``; rows with a field that is no number
    are left out."""
    rows = _packed_numbers(records, keep)
    prepared_rows = prepared(rows, number_stages("numbers", K.CSV_FEATURE_FIELDS))
    key = F.concat_ws(",", "values").alias("values_text")
    return finite_rows(prepared_rows).select(*keep, key, "label", "features")


def wide_csv_regression(
    records: DataFrame, identity: Sequence[str] = tuple(K.CSV_IDENTITY)
) -> tuple[RidgeModel, DataFrame]:
    """Elastic net on the needed columns; identity and packed values are the key of a row."""
    rows = wide_csv_rows(records, identity)
    return elastic_net(rows, [*identity, "values_text"], K.SPLIT_7_3, K.CSV_SEED)


def wide_csv_regression_by_mllib(
    records: DataFrame, identity: Sequence[str] = tuple(K.CSV_IDENTITY)
) -> tuple[PipelineModel, DataFrame]:
    """The same after exactly ``K.CSV_ELASTIC_NET_ITERATIONS`` of MLlib's steps."""
    rows = wide_csv_rows(records, identity)
    return elastic_net_by_mllib(
        rows, [*identity, "values_text"], K.SPLIT_7_3, K.CSV_SEED, K.CSV_ELASTIC_NET_ITERATIONS
    )


def fitted_regression(model: PipelineModel) -> LinearRegressionModel:
    return S.stage_of(model, LinearRegressionModel)
