"""Descent by rows: the updates of a plain loop from few scans."""

import numpy as np
import pytest

from linefit.operators import iterative
from linefit.operators.linear import GradientDescentRegression
from linefit.plans import testviews as T


def table(spark, x, y):
    return spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x, y)], "features array<double>, label double")


def plain(x, y, updates, step_size):
    w, path = np.zeros(x.shape[1]), []
    for i in range(updates):
        path.append(w)
        w = w - step_size / (len(x) * np.sqrt(i + 1)) * (x.T @ (x @ w - y))
    return w, [float(np.sqrt(np.mean((x @ v - y) ** 2))) for v in path + [w]]


@pytest.fixture
def scans(monkeypatch):
    """Number of passes over the staged rows."""
    seen = []
    original = iterative.Rows.totals

    def totals(self, function, length):
        seen.append(length)
        return original(self, function, length)

    monkeypatch.setattr(iterative.Rows, "totals", totals)
    return seen


@pytest.mark.parametrize("width, most", [(1, 2), (3, 2), (16, 2), (17, 3), (70, 6)])
def test_path_equals_a_plain_loop(spark, scans, width, most):
    random = np.random.default_rng(width)
    x = random.uniform(0, 1, (400, width)) * np.linspace(1, 0.1, width) / np.sqrt(width)
    y = x @ random.standard_normal(width) + 0.1 * random.standard_normal(400)
    model = GradientDescentRegression(numIterations=60, solver="rows").fit(table(spark, x, y))
    w, errors = plain(x, y, 60, 1.0)
    np.testing.assert_allclose(model.weights, w, rtol=1e-9, atol=1e-11)
    np.testing.assert_allclose([*model.history, model.final_rmse], errors, rtol=1e-10)
    assert len(scans) <= most


def test_wide_rows_need_fewer_scans_than_updates(spark, scans):
    random = np.random.default_rng(2)
    x = random.standard_normal((90, 300)) / 30
    y = random.standard_normal(90)
    model = GradientDescentRegression(numIterations=100, solver="rows").fit(table(spark, x, y))
    w, errors = plain(x, y, 100, 1.0)
    np.testing.assert_allclose(model.weights, w, rtol=1e-8, atol=1e-10)
    np.testing.assert_allclose(model.history, errors[:-1], rtol=1e-9)
    assert len(scans) <= 20


def test_one_update_and_none(spark):
    x, y = np.array([[0.5], [1.0]]), np.array([1.0, 2.0])
    for updates in (0, 1):
        model = GradientDescentRegression(numIterations=updates, solver="rows").fit(table(spark, x, y))
        w, errors = plain(x, y, updates, 1.0)
        np.testing.assert_allclose(model.weights, w)
        np.testing.assert_allclose([*model.history, model.final_rmse], errors)


def test_divergence_is_found_at_the_same_update(spark, folder):
    rows = T.price_rows(spark, folder)
    found = []
    for solver in ("moments", "rows"):
        with pytest.raises(ArithmeticError) as error:
            GradientDescentRegression(numIterations=90, stepSize=1e9, solver=solver).fit(rows)
        found.append(str(error.value))
    assert found[0] == found[1]


def test_blocks_hold_the_rows(spark):
    random = np.random.default_rng(7)
    x, y = random.standard_normal((500, 5)), random.standard_normal(500)
    df = spark.createDataFrame([(r.tolist(), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))],
                               "features array<double>, label double, fold int").repartition(4)
    old, iterative.BLOCK_BYTES = iterative.BLOCK_BYTES, 8 * 6 * 20
    try:
        from pyspark.sql import functions as F

        with iterative.BlockRows(df, "label", "features", F.col("fold"), 5) as rows:
            blocks = rows.blocks.collect()
            sums = rows.totals(lambda z: np.append(z.sum(axis=0), len(z)), 7)
    finally:
        iterative.BLOCK_BYTES = old
    assert max(b["n"] for b in blocks) <= 20 and len({b["block"] for b in blocks}) == len(blocks) > 20
    z = np.column_stack([x, y])
    for f in range(3):
        np.testing.assert_allclose(sums[f], np.append(z[f::3].sum(axis=0), len(z[f::3])))
