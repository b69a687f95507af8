"""Solvers that read staged rows few times: consensus, sketched and shifted systems."""

import numpy as np
import pytest

from linefit.operators import consensus, iterative, sketch
from linefit.operators.linear import ElasticNetRegression, RidgeRegression
from linefit.operators.tuning import RidgeGridSearch


def table(spark, x, y, parts=5):
    rows = [(r.tolist(), float(v), i % 3) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "features array<double>, label double, fold int").repartition(parts)


@pytest.fixture
def scans(monkeypatch):
    """Passes over staged rows, and rounds over factors of them."""
    seen = []
    totals, gathered = iterative.Rows.totals, consensus._gathered

    def counted(self, function, length):
        seen.append("rows")
        return totals(self, function, length)

    def counted_round(found):
        seen.append("factors")
        return gathered(found)

    monkeypatch.setattr(iterative.Rows, "totals", counted)
    monkeypatch.setattr(consensus, "_gathered", counted_round)
    return seen


def correlated(seed, n, width, shared=1.0):
    random = np.random.default_rng(seed)
    x = random.standard_normal((n, width)) + shared * random.standard_normal((n, 1)) + 3
    return x, x[:, :5].sum(axis=1) + random.standard_normal(n)


def test_sketch_settles_soon_whatever_the_condition(spark, scans):
    random = np.random.default_rng(0)
    q = np.linalg.qr(random.standard_normal((120, 120)))[0]
    x = (random.standard_normal((2000, 120)) * np.logspace(0, -6, 120)) @ q
    y = x @ random.standard_normal(120) + 1e-3 * random.standard_normal(2000)
    model = RidgeRegression(solver="sketched").fit(table(spark, x, y))
    w = np.linalg.lstsq(np.column_stack([x, np.ones(2000)]), y, rcond=None)[0]
    assert np.linalg.norm(model.weights - w[:-1]) < 1e-4 * np.linalg.norm(w)
    assert model.gap < 1e-9 and len(scans) <= 27


@pytest.mark.parametrize("reg", [0.0, 0.2])
def test_sketch_equals_moments(spark, reg):
    x, y = correlated(1, 300, 12)
    x[:, 3] = 5.0  # constant
    x[:, 4] = x[:, 5]  # twice the same
    df = table(spark, x, y)
    a, b = (RidgeRegression(regParam=reg, solver=s).fit(df) for s in ("moments", "sketched"))
    np.testing.assert_allclose(b.weights, a.weights, rtol=1e-6, atol=1e-8)
    assert b.weights[3] == 0 and b.train_rmse == pytest.approx(a.train_rmse, rel=1e-9)


def test_sketch_of_more_features_than_rows(spark):
    x, y = correlated(2, 40, 90)
    df = table(spark, x, y)
    a, b = (RidgeRegression(regParam=0.5, solver=s).fit(df) for s in ("moments", "sketched"))
    np.testing.assert_allclose(b.weights, a.weights, rtol=1e-6, atol=1e-9)


def test_way_follows_the_width():
    ridge, net = RidgeRegression(), ElasticNetRegression(elasticNetParam=0.5)
    assert not ridge.by_rows(2000) and ridge.by_rows(2001) and ridge.way(2001) == "sketched"
    assert ridge.way(sketch.WIDEST + 1) == "rows" and net.way(2001) == "consensus"
    with pytest.raises(ValueError, match="solver"):
        ridge.copy({ridge.solver: "consensus"}).by_rows(3)


@pytest.mark.parametrize("block_rows", [7, 10_000])
@pytest.mark.parametrize("reg, share", [(0.3, 0.5), (100.0, 1.0), (0.0, 0.5)])
def test_consensus_equals_moments(spark, scans, monkeypatch, block_rows, reg, share):
    """Agents by products (many rows) and by inner products (blocks of fewer rows than features)."""
    monkeypatch.setattr(iterative, "BLOCK_BYTES", block_rows * 8 * 21)
    x, y = correlated(3, 250, 20)
    x[:, 7] = -1.5
    df = table(spark, x, y)
    a, b = (ElasticNetRegression(regParam=reg, elasticNetParam=share, solver=s).fit(df) for s in ("moments", "consensus"))
    np.testing.assert_allclose(b.weights, a.weights, rtol=1e-6, atol=1e-8)
    assert b.intercept == pytest.approx(a.intercept, rel=1e-6) and b.gap < 1e-8
    assert len(scans) <= 60


def test_rounds_alone_come_to_the_same_weights(spark, monkeypatch):
    """Where too many features are in use for a matrix of products, rounds go on until they settle."""
    monkeypatch.setattr(consensus.M, "WIDE", 0)
    x, y = correlated(4, 200, 8, shared=0.3)
    df = table(spark, x, y, 3)
    net = ElasticNetRegression(regParam=0.1, elasticNetParam=0.5, maxIter=120, solver="consensus").fit(df)
    path = ElasticNetRegression(regParam=0.1, elasticNetParam=0.5, solver="moments").fit(df)
    np.testing.assert_allclose(net.weights, path.weights, atol=1e-7)


def test_consensus_with_agents_that_disagree(spark, scans):
    """Rows sorted by a feature, so that no task's rows look like all rows."""
    x, y = correlated(5, 240, 6)
    order = np.argsort(x[:, 0])
    df = spark.createDataFrame([(r.tolist(), float(v)) for r, v in zip(x[order], y[order])],
                               "features array<double>, label double").coalesce(6)
    a, b = (ElasticNetRegression(regParam=0.2, elasticNetParam=0.7, solver=s).fit(df) for s in ("moments", "consensus"))
    np.testing.assert_allclose(b.weights, a.weights, rtol=1e-7, atol=1e-9)
    assert len(scans) <= 60


def test_one_vector_per_fold_goes_through_the_rows(spark, monkeypatch):
    x, y = correlated(6, 300, 10)
    df = table(spark, x, y)
    lengths = []
    totals = iterative.Rows.totals

    def counted(self, function, length):
        lengths.append(length)
        return totals(self, function, length)

    monkeypatch.setattr(iterative.Rows, "totals", counted)
    regs = [0.0, 0.005, 0.05, 0.08, 0.1, 0.15, 0.3, 0.5, 20.0]
    a, b = (RidgeGridSearch(regParams=regs, foldCol="fold", solver=s).fit(df) for s in ("moments", "rows"))
    assert [e[3] for e in b.errors] == pytest.approx([e[3] for e in a.errors], rel=1e-9)
    np.testing.assert_allclose(b.weights, a.weights, rtol=1e-7)
    assert b.gap < 1e-9
    inner = lengths[1:-2]  # between the scales and the gaps and errors of all models
    assert set(inner) == {4 * 11} and len(inner) <= 14  # three folds and all rows, one vector each


def test_a_label_that_does_not_vary(spark):
    x, _ = correlated(7, 60, 4)
    df = table(spark, x, np.full(60, 2.5))
    for model in (
        RidgeRegression(regParam=0.1, solver="sketched").fit(df),
        ElasticNetRegression(regParam=0.1, elasticNetParam=0.5, solver="consensus").fit(df),
        RidgeGridSearch(regParams=[0.1, 1.0], foldCol="fold", solver="rows").fit(df),
    ):
        assert not model.weights.any() and model.intercept == pytest.approx(2.5)


def test_the_driver_receives_one_triangle_of_the_sketch(spark, monkeypatch):
    x, y = correlated(8, 3000, 50)
    df = table(spark, x, y)
    received, to_arrow = [], type(df).toArrow

    def counted(self):
        table = to_arrow(self)
        received.append(table.nbytes)
        return table

    monkeypatch.setattr(sketch, "PIECE", 16)
    with iterative.BlockRows(df, "label", "features", None, 50) as rows:
        problem = iterative.Problem(rows, [iterative.Model(0.0)])
        monkeypatch.setattr(type(df), "toArrow", counted)
        p = sketch.preconditioner(problem, 0.01)
    assert received and sum(received) < 1.2 * 8 * 50**2
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    lengths = np.linalg.eigvalsh(p.T @ (z.T @ z / len(z) + 0.01 * np.eye(50)) @ p)
    assert 0.3 < lengths.min() and lengths.max() < 3


def test_staged_blocks_are_written_and_read_a_few_at_a_time(spark, monkeypatch):
    import pyarrow.parquet as pq

    monkeypatch.setattr(iterative, "BLOCK_BYTES", 8 * 21 * 10)
    x, y = correlated(9, 500, 20)
    before = spark.conf.get(iterative.BATCH_LIMIT)
    with iterative.BlockRows(table(spark, x, y, 1), "label", "features", None, 20) as rows:
        assert spark.conf.get(iterative.BATCH_LIMIT) == f"{iterative.BATCH_BYTES}b"
        files = [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata for f in rows.blocks.inputFiles()]
        groups = [m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)]
        assert sum(groups) >= 50 and max(groups) <= 3
    assert spark.conf.get(iterative.BATCH_LIMIT) == before
