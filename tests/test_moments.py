import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linefit.operators import moments as M


def table(spark, x, y, group=None):
    rows = [
        (list(map(float, r)), float(v), int(g))
        for r, v, g in zip(x, y, group if group is not None else [0] * len(y))
    ]
    return spark.createDataFrame(rows, "features array<double>, label double, g int").repartition(3)


def by_numpy(x, y):
    z = np.column_stack([x, y])
    d = z - z.mean(axis=0)
    return len(z), z.mean(axis=0), d.T @ d


def assert_equal(found, x, y, rel=1e-9):
    n, mean, products = by_numpy(x, y)
    assert found.n == n
    np.testing.assert_allclose(found.mean, mean, rtol=rel, atol=1e-12)
    np.testing.assert_allclose(found.products, products, rtol=rel, atol=1e-9)


@pytest.fixture
def data():
    rng = np.random.default_rng(5)
    return rng.normal(size=(60, 4)), rng.normal(size=60), rng.integers(0, 3, 60)


@pytest.mark.parametrize("narrow", [M.NARROW, 0])
def test_moments_equal_numpy(spark, data, monkeypatch, narrow):
    monkeypatch.setattr(M, "NARROW", narrow)
    x, y, g = data
    assert_equal(M.collect_moments(table(spark, x, y))[None], x, y)
    groups = M.collect_moments(table(spark, x, y, g), by=F.col("g"))
    assert sorted(groups) == [0, 1, 2]
    for k, found in groups.items():
        assert_equal(found, x[g == k], y[g == k])
    named = M.collect_moments(table(spark, x, y, g), by=F.concat(F.lit("fold "), F.col("g")))
    assert sorted(named) == ["fold 0", "fold 1", "fold 2"]


@pytest.mark.parametrize("narrow", [M.NARROW, 0])
def test_large_mean_keeps_its_digits(spark, data, monkeypatch, narrow):
    """Plain sums of squares would lose all of the variance here."""
    monkeypatch.setattr(M, "NARROW", narrow)
    x, y, _ = data
    found = M.collect_moments(table(spark, x + 1e9, y))[None]
    shifted = x + 1e9
    n, mean, products = by_numpy(shifted, y)
    np.testing.assert_allclose(found.products, products, rtol=1e-6, atol=1e-4)


@pytest.mark.parametrize("narrow", [M.NARROW, 0])
@pytest.mark.parametrize("bad", [
    ([1.0, None], 1.0), ([1.0, float("nan")], 1.0), ([float("inf"), 1.0], 1.0), ([1.0], 1.0),
    ([1.0, 2.0, 3.0], 1.0), (None, 1.0), ([1.0, 2.0], None), ([1.0, 2.0], float("nan")),
])
def test_bad_rows_are_counted_and_named(spark, monkeypatch, narrow, bad):
    monkeypatch.setattr(M, "NARROW", narrow)
    good = [([1.0, 2.0], 1.0), ([2.0, 1.0], 0.5)]
    df = spark.createDataFrame([*good, bad], "features array<double>, label double")
    with pytest.raises(M.BadRows, match="1 of 3 rows"):
        M.collect_moments(df, width=2)
    finite = M.finite_rows(df, width=2)
    assert finite.count() == 2
    assert M.collect_moments(finite)[None].n == 2


def test_finite_rows_of_wide_vectors(spark):
    wide = [float(i) for i in range(40)]
    df = spark.createDataFrame(
        [(wide, 1.0), (wide[:-1] + [None], 1.0), (wide[:-1], 1.0)],
        "features array<double>, label double",
    )
    assert M.finite_rows(df, width=40).count() == 1


@pytest.mark.parametrize("width", [3, 20])
def test_empty_table(spark, width):
    df = spark.createDataFrame([], "features array<double>, label double")
    with pytest.raises(ValueError, match="no rows"):
        M.collect_moments(df)
    with pytest.raises(ValueError, match="no rows"):
        M.collect_moments(df, width=width)


def test_small_pieces_change_nothing(spark, data, monkeypatch):
    x, y, g = data
    df = table(spark, x, y, g)
    monkeypatch.setattr(M, "NARROW", 0)
    monkeypatch.setattr(M, "PIECE", 12)
    for k, found in M.collect_moments(df, by=F.col("g")).items():
        assert_equal(found, x[g == k], y[g == k])
    n, squares, _ = M.squared_loss(df, np.zeros(4))
    assert n == 60 and squares == pytest.approx(float(y @ y))


def test_another_width_is_a_bad_row_at_any_width(spark):
    df = spark.createDataFrame([([0.0], 1.0)], "features array<double>, label double")
    with pytest.raises(M.BadRows):
        M.collect_moments(df, width=M.WIDE + 1)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 5), st.integers(2, 4))
def test_merging_equals_the_whole(seed, width, parts):
    rng = np.random.default_rng(seed)
    x, y = rng.normal(3, 2, size=(30, width)), rng.normal(size=30)
    cuts = np.array_split(np.arange(30), parts)
    pieces = []
    for c in cuts:
        n, mean, products = by_numpy(x[c], y[c])
        pieces.append(M.Moments(n, mean, products))
    assert_equal(M.merge(pieces), x, y)


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 5))
def test_error_and_gradient_follow_from_moments(seed, width):
    rng = np.random.default_rng(seed)
    x, y, w = rng.normal(1, 2, size=(25, width)), rng.normal(size=25), rng.normal(size=width)
    found = M.Moments(*by_numpy(x, y))
    assert found.rmse(w, 0.5) == pytest.approx(np.sqrt(np.mean((y - x @ w - 0.5) ** 2)))
    np.testing.assert_allclose(found.gradient(w), (x @ w - y) @ x, rtol=1e-8, atol=1e-8)


def test_loss_over_rows_equals_loss_from_moments(spark, data):
    x, y, _ = data
    w = np.array([0.5, -1.0, 0.25, 2.0])
    n, squares, g = M.squared_loss(table(spark, x, y), w)
    found = M.Moments(*by_numpy(x, y))
    assert n == 60
    assert np.sqrt(squares / n) == pytest.approx(found.rmse(w))
    np.testing.assert_allclose(g, found.gradient(w))
    with pytest.raises(M.BadRows):
        M.squared_loss(table(spark, x, y), w[:-1])


def test_one_scan(spark, data, jobs_of):
    x, y, g = data
    df = table(spark, x, y, g)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        _, jobs = jobs_of(lambda: M.collect_moments(df, by=F.col("g"), width=4))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert jobs == 1


@pytest.mark.parametrize("width", [1, M.FEW])
def test_a_column_far_from_zero_takes_one_pass(spark, jobs_of, width):
    random = np.random.default_rng(9)
    x = random.standard_normal((3000, width)) * 1e-3 + 1e6
    y = x.sum(axis=1) + random.standard_normal(3000) * 1e-3
    far, near = (table(spark, x - shift, y - shift) for shift in (0.0, 1e6))
    found, jobs = jobs_of(lambda: M.collect_moments(far, width=width)[None])
    _, wanted = jobs_of(lambda: M.collect_moments(near, width=width)[None])
    assert jobs == wanted
    z = np.column_stack([x, y])
    d = z - z.mean(axis=0)
    np.testing.assert_allclose(found.products, d.T @ d, rtol=1e-6, atol=1e-9)
    np.testing.assert_allclose(found.mean, z.mean(axis=0), rtol=1e-12)


def test_groups_of_one_row_and_hot_groups(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0], 3.0)] * 50 + [(1, [4.0, 5.0], 6.0)], "g int, features array<double>, label double")
    found = M.collect_moments(df, by=F.col("g"), width=2)
    assert found[0].n == 50 and found[1].n == 1
    assert not found[0].products.any() and not found[1].products.any()
    assert found[1].mean.tolist() == [4.0, 5.0, 6.0]
