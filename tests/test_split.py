import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linefit.operators.split import cut_points, fold_number, hash_split, with_part


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(20000).withColumn("k", F.col("id").cast("string"))


@pytest.mark.parametrize("weights", [[0.7, 0.3], [0.9, 0.1], [2, 1, 1], [1.0]])
def test_parts_are_disjoint_and_complete(rows, weights):
    parts = hash_split(rows, weights, ["k"], seed=12345)
    assert len(parts) == len(weights)
    ids = [{r.id for r in p.collect()} for p in parts]
    assert sum(map(len, ids)) == 20000 and len(set().union(*ids)) == 20000
    for part, weight in zip(ids, weights):
        assert len(part) / 20000 == pytest.approx(weight / sum(weights), abs=0.02)
    numbered = with_part(rows, weights, ["k"], seed=12345).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in numbered} == {i: len(s) for i, s in enumerate(ids)}


def test_split_does_not_depend_on_partitioning(rows):
    a, _ = hash_split(rows, [0.7, 0.3], ["k"], seed=1)
    b, _ = hash_split(rows.repartition(7), [0.7, 0.3], ["k"], seed=1)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_seed_matters(rows):
    a, _ = hash_split(rows, [0.5, 0.5], ["k"], seed=1)
    b, _ = hash_split(rows, [0.5, 0.5], ["k"], seed=2)
    assert a.exceptAll(b).count() > 4000


def test_null_keys_are_kept(spark):
    df = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    assert sum(p.count() for p in hash_split(df, [0.5, 0.5], ["k"])) == 2


def test_folds_are_even_and_independent_of_the_split(rows):
    train, _ = hash_split(rows, [0.9, 0.1], ["k"], seed=3)
    counts = train.groupBy(fold_number(["k"], 3, seed=3).alias("f")).count().collect()
    assert len(counts) == 3
    assert all(abs(r["count"] / 6000 - 1) < 0.05 for r in counts)


@settings(max_examples=50)
@given(st.lists(st.floats(0.01, 100), min_size=1, max_size=6))
def test_cut_points(weights):
    cuts = cut_points(weights)
    assert cuts == sorted(cuts) and cuts[-1] == 2**32 and len(cuts) == len(weights)


def test_weights_must_be_positive():
    with pytest.raises(ValueError):
        cut_points([0.5, 0.0])


def test_hot_key_stays_whole(spark):
    """A third of the rows are copies of one line: they move together, none is lost."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("value")
    )
    parts = hash_split(rows, [0.7, 0.3], ["value"])
    copies = sorted(p.filter("value = 'copy'").count() for p in parts)
    assert copies == [0, 3000] and sum(p.count() for p in parts) == 9000
    others = [p.filter("value <> 'copy'").count() / 6000 for p in parts]
    assert others == pytest.approx([0.7, 0.3], abs=0.03)
