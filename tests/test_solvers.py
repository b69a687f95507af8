"""The same answers by moments and by rows, certain errors, and one rule for widths."""

import glob
import time

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from linefit.functions import vectors as V
from linefit.operators import moments as M
from linefit.operators import stages as S
from linefit.operators import summary
from linefit.operators.linear import (
    ElasticNetRegression,
    GradientDescentRegression,
    LinearModel,
    RidgePath,
    RidgeRegression,
)
from linefit.operators.tuning import RidgeGridSearch
from linefit.plans import programs, regression
from linefit.plans import testviews as T
from linefit.sources import staging

SCHEMA = "features array<double>, label double, fold int"


def table(spark, x, y):
    return spark.createDataFrame(
        [(r.tolist(), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))], SCHEMA
    )


@pytest.fixture(scope="module")
def rows(spark):
    random = np.random.default_rng(3)
    x = random.standard_normal((300, 6)) @ random.standard_normal((6, 6)) + 5
    return table(spark, x, x @ [1.0, -2.0, 0, 0, 0.5, 0] + random.standard_normal(300))


@pytest.mark.parametrize("make", [
    lambda s: GradientDescentRegression(numIterations=4, stepSize=1e-3, solver=s),
    lambda s: RidgeRegression(regParam=0.3, maxIter=300, solver=s),
    lambda s: ElasticNetRegression(regParam=0.3, elasticNetParam=0.5, maxIter=5000, solver=s),
    lambda s: RidgeGridSearch(regParams=[0.0, 0.1, 1.0], foldCol="fold", solver=s),
])
def test_rows_and_moments_agree(rows, make):
    a, b = (make(s).fit(rows) for s in ("moments", "rows"))
    np.testing.assert_allclose(a.weights, b.weights, rtol=1e-7, atol=1e-9)
    assert a.intercept == pytest.approx(b.intercept, abs=1e-6)
    if hasattr(a, "errors"):
        assert [e[:3] for e in a.errors] == [e[:3] for e in b.errors]
        assert [e[3] for e in a.errors] == pytest.approx([e[3] for e in b.errors], rel=1e-7)


def test_unknown_solver_is_refused(rows):
    with pytest.raises(ValueError, match="solver"):
        RidgeRegression(solver="fast").fit(rows)


def test_degree_two_grid_over_wide_vectors(spark, folder):
    """2,144 products of the 64 numbers of an embedding: read by rows, as the default says."""
    wide = regression.with_products(T.embedding_rows(spark, folder).withColumn(
        "features", F.col("features").cast("array<double>").alias(
            "features", metadata=V.width_metadata(64)
        )
    ))
    search = RidgeGridSearch(featuresCol="products", regParams=[0.5], keyCols=["vec_id"])
    width = V.degree_two_width(64)
    assert search.by_rows(width)
    model = search.fit(wide)
    assert model.numFeatures == width and np.isfinite(model.train_rmse) and model.gap < 1e-6


@pytest.mark.parametrize("noise", [1e-9, 1e-10])
def test_errors_of_near_perfect_fits_are_those_of_the_rows(spark, noise):
    random = np.random.default_rng(4)
    x = random.uniform(0, 1, (600, 1))
    y = 2 * x[:, 0] + 1 + noise * random.standard_normal(600)
    df = table(spark, x, y)
    z = np.column_stack([x, np.ones(600)])

    def error(train, test):
        w = np.linalg.lstsq(z[train], y[train], rcond=None)[0]
        return np.sqrt(np.mean((y[test] - z[test] @ w) ** 2))

    everything = np.ones(600, bool)
    assert RidgeRegression().fit(df).train_rmse == pytest.approx(error(everything, everything), rel=1e-3)
    model = RidgeGridSearch(regParams=[0.0], foldCol="fold").fit(df)
    fold = np.arange(600) % 3
    for _, _, f, rmse in model.errors:
        assert rmse == pytest.approx(error(fold != f, fold == f), rel=2e-3)
    assert model.train_rmse == pytest.approx(error(everything, everything), rel=1e-3)


def test_history_of_a_near_perfect_descent_is_that_of_the_rows(spark):
    x = np.linspace(0, 1, 50)[:, None]
    y = x[:, 0] * 1e-3
    model = GradientDescentRegression(numIterations=40, stepSize=2.0).fit(table(spark, x, y))
    w, history = 0.0, []
    for i in range(40):
        history.append(np.sqrt(np.mean((w * x[:, 0] - y) ** 2)))
        w -= 2.0 / (50 * np.sqrt(i + 1)) * np.sum((w * x[:, 0] - y) * x[:, 0])
    np.testing.assert_allclose(model.history, history, rtol=1e-6)


def test_elastic_net_of_many_correlated_features_settles_soon():
    random = np.random.default_rng(5)
    x = random.standard_normal((1200, 400)) + 2 * random.standard_normal((1200, 1))
    y = x[:, :20].sum(axis=1) + random.standard_normal(1200)
    z = np.column_stack([x, y])
    d = z - z.mean(axis=0)
    path = RidgePath(M.Moments(len(z), z.mean(axis=0), d.T @ d))
    start = time.perf_counter()
    path.solve(0.1, 0.5)
    assert time.perf_counter() - start < 2
    assert path.gap < 1e-9
    path.solve(0.1, 0.5, sweeps=1)
    assert path.gap > 1e-6


def test_model_says_that_it_was_stopped_short(rows):
    model = ElasticNetRegression(regParam=0.3, elasticNetParam=0.5, maxIter=2, solver="rows").fit(rows)
    assert model.gap > 1e-6


@pytest.mark.parametrize("width", [2, V.WRITTEN_OUT + 4])
@pytest.mark.parametrize("off", [-1, 1])
def test_one_rule_for_other_widths(spark, width, off):
    good, bad = [1.0] * width, [1.0] * (width + off)
    schema = spark.createDataFrame([(good,), (None,)], "features array<double>").schema
    schema["features"].metadata = V.width_metadata(width)
    fine = spark.createDataFrame([(good,), (None,)], schema)
    mixed = spark.createDataFrame([(good,), (bad,), (None,)], schema)
    expand = S.DegreeTwo(inputCol="features", outputCol="products")
    for use in (
        lambda df: summary.vector_sum(df, "features"),
        lambda df: expand.transform(df).select("products"),
        lambda df: LinearModel(np.ones(width)).setFeaturesCol("features").transform(df),
    ):
        assert use(fine).collect()
        with pytest.raises(PySparkException, match="vector widths differ"):
            use(mixed).collect()
    terms = [r.products for r in expand.transform(fine).collect()]
    assert len(terms[0]) == V.degree_two_width(width) and terms[1] is None
    nothing = spark.createDataFrame([(None,)], schema)
    assert summary.vector_sum(nothing, "features").collect() == []
    unnamed = spark.createDataFrame([(good,), (bad,)], "features array<double>")
    with pytest.raises(PySparkException, match="vector widths differ"):
        summary.vector_sum(unnamed, "features").collect()


def test_finite_rows_do_not_trust_one_row(spark):
    df = spark.createDataFrame([([1.0], 1.0)] + [([1.0, 2.0], 1.0)] * 9, "features array<double>, label double")
    with pytest.raises(M.BadRows, match="1 to 2 wide"):
        M.finite_rows(df)
    assert M.finite_rows(df, width=2).count() == 9
    assert M.finite_rows(df.where("false")).count() == 0


def test_scoring_at_great_width_builds_its_plan_soon(spark):
    df = spark.createDataFrame([([0.5] * 20_000,)], "features array<double>")
    start = time.perf_counter()
    scored = LinearModel(np.full(20_000, 2.0)).setFeaturesCol("features").transform(df)
    scored._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 4
    assert scored.first()["prediction"] == pytest.approx(20_000.0)


def test_staged_rows_are_released(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    left = lambda: [p for p in glob.glob(f"{shared}/linefit/row-blocks-*")]
    rows = T.price_rows(spark, folder)
    GradientDescentRegression(numIterations=2, solver="rows").fit(rows)
    assert left() == []
    with pytest.raises(ArithmeticError):
        GradientDescentRegression(numIterations=50, stepSize=1e6, solver="rows").fit(rows)
    with pytest.raises(M.BadRows):
        GradientDescentRegression(solver="rows").fit(rows.withColumn("label", F.lit(float("nan"))))
    assert left() == []


def test_per_row_draws_keep_the_shares(spark, folder, tmp_path):
    from linefit.operators.split import fold_number, with_part

    line = "2001.0,0.5,0.25,0.1" + ",0" * 9
    lines = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, line).otherwise(
            F.concat(F.lit("2001.0,"), F.col("id") / 6000, F.lit(",0.3,0.2" + ",0" * 9))
        ).alias("value")
    )
    parted = with_part(lines, [0.7, 0.3], None, 1).groupBy("part").count().collect()
    assert {r.part: r["count"] / 6000 for r in parted} == pytest.approx({0: 0.7, 1: 0.3}, abs=0.02)
    folds = lines.groupBy(fold_number(None, 3).alias("f")).count().collect()
    assert {r.f: r["count"] / 6000 for r in folds} == pytest.approx(dict.fromkeys(range(3), 1 / 3), abs=0.02)
    path = staging.write_lines(lines, "equal")
    for name in programs.SPLITTING:
        assert programs.PROGRAMS[name](spark, path, keys=None)["errors"].count() == 2


def test_programs_preview_test_rows_and_count_rejects(spark, folder):
    path = staging.write_lines(T.non_finite_song_lines(spark, folder), "odd")
    source = programs._Lines(spark, path)
    test = {
        "elastic-net": ([0.7, 0.3], 0), "ridge-search": ([0.9, 0.1], 12345),
        "degree-two-search": ([0.9, 0.1], 12345), "descent": ([0.9, 0.1], 0),
    }
    for name, (weights, seed) in test.items():
        tables = programs.PROGRAMS[name](spark, path)
        tested = regression.test_rows(source.rows(), weights, ["value"], seed)
        labels = {round(r.label, 9) for r in tested.select("label").collect()}
        shown = tables["scored"].collect()
        assert shown and {round(r.label, 9) for r in shown} <= labels
        rejected = {r.reason: r["count"] for r in tables["rejected"].collect()}
        assert set(rejected) == {"non_finite"}
        assert rejected["non_finite"] == T.table(spark, folder, "lineitem").where("l_linenumber <= 3").count()


@pytest.mark.parametrize("noise", [0.0, 1e-10])
def test_program_of_a_near_perfect_descent_tells_the_errors_of_its_rows(spark, noise):
    random = np.random.default_rng(8)
    x = random.uniform(0, 1.5, 500)
    y = 0.5 * x + noise * random.standard_normal(500)
    df = spark.createDataFrame(
        [(i, [float(a)], float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, features array<double>, label double"
    )
    model, errors = regression.gradient_descent(df, ["id"])
    train = {r.id for r in regression.hash_split(df, [0.9, 0.1], ["id"], 0)[0].select("id").collect()}
    own = np.array([i in train for i in range(500)])
    w, history = 0.0, []
    for i in range(100):
        history.append(np.sqrt(np.mean((w * x[own] - y[own]) ** 2)))
        w -= np.mean((w * x[own] - y[own]) * x[own]) / np.sqrt(i + 1)
    np.testing.assert_allclose(model.history, history, rtol=1e-3, atol=1e-16)
    assert errors.count() == 2
