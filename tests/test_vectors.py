import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from linefit.functions import vectors as V
from linefit.operators import summary

numbers = st.floats(-1e6, 1e6)


def table(spark, rows):
    return spark.createDataFrame(rows, "a array<double>, b array<double>")


@settings(max_examples=8, deadline=None)
@given(st.integers(1, 20).flatmap(
    lambda n: st.tuples(st.lists(numbers, min_size=n, max_size=n),
                        st.lists(numbers, min_size=n, max_size=n), numbers)))
def test_arithmetic(spark, case):
    a, b, s = case
    row = table(spark, [(a, b)]).select(
        V.dot(F.col("a"), F.col("b")).alias("dot"),
        V.dot_weights(F.col("a"), b).alias("weighted"),
        V.scale(F.col("a"), s).alias("scaled"),
        V.add(F.col("a"), F.col("b")).alias("sum"),
        V.fill(F.size("a"), s).alias("filled"),
    ).first()
    expected = 0.0
    for x, y in zip(a, b):
        expected += x * y
    assert row.dot == pytest.approx(expected, rel=1e-12, abs=1e-3)
    assert row.weighted == pytest.approx(expected, rel=1e-12, abs=1e-3)
    assert row.scaled == [x * s for x in a]
    assert row.sum == [x + y for x, y in zip(a, b)]
    assert row.filled == [s] * len(a)


@pytest.mark.parametrize("operation", [
    lambda: V.dot(F.col("a"), F.col("b")),
    lambda: V.add(F.col("a"), F.col("b")),
    lambda: V.dot_weights(F.col("a"), [1.0, 2.0]),
    lambda: V.dot_weights(F.col("a"), [1.0] * 40),
])
def test_unequal_widths_are_an_error(spark, operation):
    df = table(spark, [([1.0, 2.0, 3.0], [1.0, 2.0])])
    with pytest.raises(PySparkException, match="vector widths differ"):
        df.select(operation()).collect()


def test_null_vector_gives_null(spark):
    df = table(spark, [(None, [1.0])])
    row = df.select(V.dot(F.col("a"), F.col("b")), V.dot_weights(F.col("a"), [1.0])).first()
    assert tuple(row) == (None, None)


def test_not_a_vector(spark):
    with pytest.raises(TypeError):
        V.as_array(spark.range(1), "id")


def test_vector_sum_with_one_hot_key(spark):
    """A third of all rows under one key: partial sums leave one row per task and position."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("key"),
        F.array(F.lit(1.0), F.col("id").cast("double")).alias("v"),
    )
    sums = summary.vector_sum(rows, "v", by=["key"])
    hot = {r.idx: r.value for r in sums.filter("key = 0").collect()}
    assert hot == {0: 1000.0, 1: float(sum(range(0, 3000, 3)))}
    assert [tuple(r) for r in summary.widths(rows, "v").collect()] == [(2, 3000)]
    assert sums.count() == 2 * 2001


def test_preview_needs_an_order(spark):
    with pytest.raises(ValueError):
        summary.first_rows(spark.range(3), 2)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "year int")
    assert tuple(summary.row_count(empty).first()) == (0,)
    assert tuple(summary.min_max_avg(empty, "year").first()) == (None, None, None)
    assert summary.count_per_key(empty, "year").count() == 0


def test_long_vectors_are_summed_as_blocks(spark, monkeypatch):
    """No row per element before the sums, null elements add nothing, any number and kind of keys."""
    import numpy as np
    import pytest

    monkeypatch.setattr(summary, "HELD", 50)
    random = np.random.default_rng(1)
    data = [(i % 300 if i % 7 else None, "ab"[i % 2], [None if j == 3 and i % 2 else float(x) for j, x in enumerate(v)])
            for i, v in enumerate(random.standard_normal((900, 20)))]
    rows = spark.createDataFrame([*data, (7, "a", None), (999, "b", None)], "key int, `the kind` string, v array<double>")
    wanted = {}
    for key, kind, v in data:
        for j, x in enumerate(v):
            wanted[key, kind, j] = wanted.get((key, kind, j), 0.0) + (x or 0.0)
    for repeated in (1, 4):
        sums = summary.vector_sum(rows.repartition(repeated), "v", by=["key", "the kind"], width=20)
        found = {(r["key"], r["the kind"], r["idx"]): r["value"] for r in sums.collect()}
        assert found.keys() == wanted.keys()
        assert all(abs(found[k] - wanted[k]) < 1e-9 for k in wanted)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("MapInArrow")  # printed from the last step on
    whole = summary.vector_sum(rows, "v", width=20).orderBy("idx").collect()
    totals = [sum(v for (_, _, i), v in wanted.items() if i == j) for j in range(20)]
    assert [r["value"] for r in whole] == pytest.approx(totals)
    floats = rows.selectExpr("key", "cast(v as array<float>) v")
    assert summary.vector_sum(floats, "v", width=20).count() == 20
    with pytest.raises(Exception, match="vector widths differ"):
        summary.vector_sum(rows.selectExpr("slice(v, 1, 19) v"), "v", width=20).collect()
