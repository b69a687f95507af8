import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from linefit.operators import stages as S
from linefit.operators.split import fold_number
from linefit.operators.tuning import RidgeGridModel, RidgeGridSearch, parameter_grid
from linefit.plans import fixed_values as K
from linefit.plans import testviews as T


@pytest.fixture(scope="module")
def rows(spark, folder):
    return T.charge_rows(spark, folder).withColumn("fold", fold_number(T.LINE_KEYS, 3))


def search(**params):
    return RidgeGridSearch(regParams=K.REG_PARAMS, maxIters=K.MAX_ITERS, **params)


def test_grid_order():
    grid = parameter_grid(K.REG_PARAMS, K.MAX_ITERS)
    assert len(grid) == 49 and grid[:2] == [(0.005, 3), (0.005, 5)] and grid[-1] == (0.5, 75)


def test_equals_mllib_cross_validation(spark, rows):
    ours = RidgeGridSearch(regParams=[0.005, 0.5], maxIters=[3, 75], foldCol="fold").fit(rows)
    regression = LinearRegression(featuresCol="v")
    grid = (
        ParamGridBuilder()
        .addGrid(regression.regParam, [0.005, 0.5])
        .addGrid(regression.maxIter, [3, 75])
        .build()
    )
    theirs = CrossValidator(
        estimator=regression, estimatorParamMaps=grid, evaluator=RegressionEvaluator(),
        numFolds=3, foldCol="fold",
    ).fit(S.ToMLVector(inputCol="features", outputCol="v").transform(rows))
    means = {(r.regParam, r.maxIter): r.rmse for r in ours.mean_table(spark).collect()}
    np.testing.assert_allclose(
        [means[g] for g in parameter_grid([0.005, 0.5], [3, 75])], theirs.avgMetrics, rtol=1e-7
    )
    np.testing.assert_allclose(
        ours.weights, theirs.bestModel.coefficients.toArray(), rtol=1e-6, atol=1e-9
    )
    assert (ours.getRegParam(), ours.getMaxIter()) == (
        theirs.bestModel.getRegParam(), theirs.bestModel.getMaxIter()
    )


def test_folds_from_keys_equal_fold_column(spark, rows):
    a = search(foldCol="fold").fit(rows)
    b = search(keyCols=T.LINE_KEYS).fit(rows)
    assert a.errors == b.errors
    assert a.fold_table(spark).count() == 147


def test_whole_grid_takes_one_job(spark, rows, jobs_of):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, jobs = jobs_of(lambda: search(keyCols=T.LINE_KEYS).fit(rows))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert jobs == 1


def test_ties_go_to_the_first_entry(rows):
    assert search(foldCol="fold").fit(rows).getMaxIter() == K.MAX_ITERS[0]


def test_lopsided_folds(spark, rows):
    """Nearly all rows in one fold."""
    uneven = rows.withColumn("fold", F.when(F.col("l_linenumber") == 1, 1).otherwise(0))
    model = search(foldCol="fold").fit(uneven)
    assert len(model.errors) == 98


@pytest.mark.parametrize("fold", ["3", "-1", "null"])
def test_fold_out_of_range(rows, fold):
    with pytest.raises(Exception, match="fold numbers must be in"):
        search(foldCol="fold").fit(rows.withColumn("fold", F.expr(fold).cast("int")))


def test_one_fold_is_refused(rows):
    with pytest.raises(ValueError, match="two folds"):
        search(foldCol="fold").fit(rows.withColumn("fold", F.lit(0)))
    with pytest.raises(ValueError, match="keyCols"):
        search().fit(rows)


def test_result_survives_saving(rows, tmp_path):
    model = search(foldCol="fold").fit(rows)
    model.save(str(tmp_path / "m"))
    again = RidgeGridModel.load(str(tmp_path / "m"))
    assert again.errors == model.errors and again.getRegParam() == model.getRegParam()
    assert again.weights.tolist() == model.weights.tolist()
