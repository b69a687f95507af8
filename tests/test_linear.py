import numpy as np
import pytest
from plan_text import plan_of
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from linefit.operators import moments as M
from linefit.operators import stages as S
from linefit.operators.evaluate import rmse, rmse_table
from linefit.operators.linear import (
    GradientDescentModel,
    GradientDescentRegression,
    RidgeModel,
    RidgeRegression,
    gradient,
    gradient_terms,
)
from linefit.plans import testviews as T


def table(spark, x, y):
    rows = [(list(map(float, r)), float(v)) for r, v in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double")


def descend(x, y, updates=100, step=1.0):
    """Row by row, as the definition has it."""
    w, history = np.zeros(x.shape[1]), []
    for i in range(updates):
        history.append(np.sqrt(np.mean((y - x @ w) ** 2)))
        w = w - step / (len(y) * np.sqrt(i + 1)) * ((x @ w - y) @ x)
    return w, history


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(11)
    x = rng.uniform(size=(50, 3))
    return x, x @ np.array([0.3, -0.2, 0.9]) + 0.1 * rng.normal(size=50)


def test_descent_equals_definition(spark, numbers):
    x, y = numbers
    model = GradientDescentRegression().fit(table(spark, x, y))
    w, history = descend(x, y)
    np.testing.assert_allclose(model.weights, w, rtol=1e-10)
    np.testing.assert_allclose(model.history, history, rtol=1e-10)
    assert model.final_rmse == pytest.approx(np.sqrt(np.mean((y - x @ w) ** 2)))
    assert model.final_rmse < model.history[-1]
    assert model.intercept == 0.0 and model.numFeatures == 3


def test_descent_over_rows_equals_descent_over_moments(spark, numbers, monkeypatch):
    x, y = numbers
    monkeypatch.setattr(M, "WIDE", 2)
    model = GradientDescentRegression(numIterations=6, stepSize=0.5).fit(table(spark, x, y))
    w, history = descend(x, y, 6, 0.5)
    np.testing.assert_allclose(model.weights, w, rtol=1e-10)
    np.testing.assert_allclose(model.history, history, rtol=1e-10)


def test_descent_that_diverges_says_so(spark, numbers):
    x, y = numbers
    with pytest.raises(ArithmeticError, match="diverged"):
        GradientDescentRegression().fit(table(spark, x * 1000, y))


def test_no_updates(spark, numbers):
    model = GradientDescentRegression(numIterations=0).fit(table(spark, *numbers))
    assert model.weights.tolist() == [0.0, 0.0, 0.0] and model.history == []


def test_gradient_columns(spark, numbers):
    x, y = numbers
    w = [0.1, 0.2, 0.3]
    g = {r.idx: r.value for r in gradient(table(spark, x, y), w).collect()}
    np.testing.assert_allclose([g[i] for i in range(3)], (x @ w - y) @ x)
    terms = gradient_terms(table(spark, x, y), w)
    first = terms.first()
    np.testing.assert_allclose(
        first["gradient_term"],
        (np.dot(first.features, w) - first.label) * np.array(first.features),
    )


def test_fit_takes_one_job(spark, numbers, jobs_of):
    rows = S.VectorPicker(inputCol="features", outputCol="f", indices=[0, 1, 2]).transform(
        table(spark, *numbers)
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for estimator in (GradientDescentRegression(featuresCol="f"),
                          RidgeRegression(featuresCol="f", regParam=0.1)):
            _, jobs = jobs_of(lambda: estimator.fit(rows))
            assert jobs == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_scoring_is_an_expression(spark, numbers):
    rows = table(spark, *numbers)
    model = GradientDescentRegression(predictionCol="p").fit(rows)
    scored = model.transform(rows)
    assert "UDF" not in plan_of(scored) and "Python" not in plan_of(scored)
    row = scored.first()
    assert row.p == pytest.approx(model.predict(row.features))
    assert row.p == pytest.approx(model.predict(Vectors.dense(row.features)))


def test_models_take_mllib_vectors(spark, numbers):
    rows = table(spark, *numbers)
    vectors = rows.withColumn("features", array_to_vector("features"))
    a, b = (GradientDescentRegression().fit(r) for r in (rows, vectors))
    np.testing.assert_allclose(a.weights, b.weights)
    assert rmse(a.transform(vectors)) == pytest.approx(a.final_rmse)


def test_wrong_width_is_refused(spark, numbers):
    model = GradientDescentRegression().fit(table(spark, *numbers))
    with pytest.raises(ValueError):
        model.predict([1.0])
    with pytest.raises(Exception, match="vector widths differ"):
        model.transform(table(spark, [[1.0, 2.0]], [0.0])).collect()
    narrow = S.VectorPicker(inputCol="features", outputCol="f", indices=[0]).transform(
        table(spark, *numbers)
    )
    with pytest.raises(ValueError, match="vector widths differ"):
        model.setFeaturesCol("f").transform(narrow)


def test_setters_and_copy():
    estimator = GradientDescentRegression().setLabelCol("l").setFeaturesCol("f")
    estimator.setPredictionCol("p")
    twin = estimator.copy({estimator.numIterations: 7})
    assert (twin.getLabelCol(), twin.getFeaturesCol(), twin.getPredictionCol()) == ("l", "f", "p")
    assert twin.getOrDefault("numIterations") == 7
    assert estimator.getOrDefault("numIterations") == 100


def test_models_survive_saving(spark, numbers, tmp_path):
    rows = table(spark, *numbers)
    model = GradientDescentRegression(predictionCol="p").fit(rows)
    model.save(str(tmp_path / "gd"))
    again = GradientDescentModel.load(str(tmp_path / "gd"))
    assert again.weights.tolist() == model.weights.tolist()
    assert again.history == model.history and again.final_rmse == model.final_rmse
    assert again.getPredictionCol() == "p"
    ridge = RidgeRegression(regParam=0.2).fit(rows)
    PipelineModel([ridge]).save(str(tmp_path / "ridge"))
    loaded = PipelineModel.load(str(tmp_path / "ridge")).stages[0]
    assert isinstance(loaded, RidgeModel)
    assert loaded.intercept == ridge.intercept and loaded.train_rmse == ridge.train_rmse
    assert loaded.getRegParam() == 0.2


@pytest.mark.parametrize("strength", [0.0, 0.005, 0.1, 0.5])
@pytest.mark.parametrize("degree_two", [False, True])
def test_ridge_equals_mllib(spark, folder, strength, degree_two):
    rows = T.charge_rows(spark, folder)
    name = "features"
    if degree_two:
        rows = S.DegreeTwo(inputCol="features", outputCol="products").transform(rows)
        name = "products"
    ours = RidgeRegression(featuresCol=name, regParam=strength).fit(rows)
    vectors = S.ToMLVector(inputCol=name, outputCol="v").transform(rows)
    theirs = LinearRegression(featuresCol="v", regParam=strength).fit(vectors)
    np.testing.assert_allclose(ours.weights, theirs.coefficients.toArray(), rtol=1e-5, atol=1e-7)
    assert ours.intercept == pytest.approx(theirs.intercept, rel=1e-5, abs=1e-7)
    assert ours.train_rmse == pytest.approx(theirs.summary.rootMeanSquaredError, rel=1e-6)
    assert rmse(ours.transform(rows)) == pytest.approx(ours.train_rmse, rel=1e-6)


def test_constant_feature_and_label(spark, numbers):
    x, y = numbers
    constant = np.column_stack([x, np.full(50, 7.7)])
    a = RidgeRegression(regParam=0.1).fit(table(spark, x, y))
    b = RidgeRegression(regParam=0.1).fit(table(spark, constant, y))
    np.testing.assert_allclose(b.weights, [*a.weights, 0.0], rtol=1e-9)
    flat = RidgeRegression().fit(table(spark, x, np.full(50, 3.25)))
    assert flat.weights.tolist() == [0, 0, 0] and flat.intercept == 3.25
    assert flat.train_rmse == 0.0


def test_perfect_fit_and_single_row(spark, numbers):
    x, _ = numbers
    model = RidgeRegression().fit(table(spark, x, x @ [1.0, 2.0, 3.0] + 4))
    np.testing.assert_allclose(model.weights, [1, 2, 3], rtol=1e-8)
    assert model.intercept == pytest.approx(4) and 0 <= model.train_rmse < 1e-6
    single = RidgeRegression(regParam=0.3).fit(table(spark, x[:1], [5.0]))
    assert single.intercept == 5.0 and single.train_rmse == 0.0


def test_collinear_features_have_the_smallest_solution(spark, numbers):
    x, y = numbers
    doubled = np.column_stack([x[:, 0], x[:, 0]])
    model = RidgeRegression().fit(table(spark, doubled, y))
    single = RidgeRegression().fit(table(spark, x[:, :1], y))
    np.testing.assert_allclose(model.weights, [single.weights[0] / 2] * 2, rtol=1e-6)


def test_rmse_of_nothing_and_by_side(spark):
    scored = spark.createDataFrame(
        [("a", 1.0, 1.0), ("b", 0.0, 3.0), ("b", 0.0, 4.0)],
        "side string, label double, prediction double",
    )
    sides = {r.side: r.value for r in rmse_table(scored, by=["side"]).collect()}
    assert sides == {"a": 0.0, "b": pytest.approx(np.sqrt(12.5))}
    assert rmse(scored.limit(0)) is None


def test_pipeline_from_text_to_model(spark, folder):
    from linefit.plans import regression

    lines = T.song_lines(spark, folder)
    stages = [*regression.line_stages(), GradientDescentRegression(numIterations=5)]
    model = Pipeline(stages=stages).fit(lines)
    fitted = S.stage_of(model, GradientDescentModel)
    assert model.stages[-1] is fitted and len(fitted.history) == 5
    assert rmse(model.transform(lines)) == pytest.approx(fitted.final_rmse)
    assert model.transform(lines).select(F.count("prediction")).first()[0] == 6000


def test_estimators_survive_saving(spark, tmp_path):
    from linefit.operators.linear import ElasticNetRegression
    from linefit.operators.tuning import RidgeGridSearch

    estimators = [
        GradientDescentRegression(numIterations=7, stepSize=0.5, labelCol="l"),
        RidgeRegression(regParam=0.3, featuresCol="f"),
        ElasticNetRegression(regParam=0.3, elasticNetParam=0.2),
        RidgeGridSearch(regParams=[0.1, 0.2], maxIters=[3], keyCols=["k"], seed=4),
    ]
    for i, estimator in enumerate(estimators):
        estimator.save(str(tmp_path / str(i)))
        again = type(estimator).load(str(tmp_path / str(i)))
        assert {p.name: v for p, v in again.extractParamMap().items()} == {
            p.name: v for p, v in estimator.extractParamMap().items()
        }


def test_elastic_net_without_absolute_penalty_is_ridge(spark, numbers):
    from linefit.operators.linear import ElasticNetRegression

    rows = table(spark, *numbers)
    ridge = RidgeRegression(regParam=0.2).fit(rows)
    net = ElasticNetRegression(regParam=0.2).fit(rows)
    assert net.weights.tolist() == ridge.weights.tolist()
    nearly = ElasticNetRegression(regParam=0.2, elasticNetParam=1e-9).fit(rows)
    np.testing.assert_allclose(nearly.weights, ridge.weights, rtol=1e-6)
    nothing = ElasticNetRegression(regParam=50.0, elasticNetParam=1.0).fit(rows)
    assert nothing.weights.tolist() == [0.0, 0.0, 0.0]
