"""The programs end to end, over files."""

import numpy as np
import pytest

from linefit.plans import fixed_values as K
from linefit.plans import programs, regression
from linefit.plans import testviews as T
from linefit.sources import staging


@pytest.fixture(scope="module")
def song_file(spark, folder):
    return staging.write_lines(T.song_lines(spark, folder), "songs")


def test_programs_over_song_lines(spark, song_file):
    for name in ("song-summary", "song-features", "elastic-net", "ridge-search",
                 "degree-two-search", "descent"):
        tables = programs.PROGRAMS[name](spark, song_file)
        assert tables, name
        for table in tables.values():
            table.collect()
    summary = programs.song_summary(spark, song_file)
    assert summary["song_count"].first()[0] == 6000
    assert summary["rejected_lines"].count() == 0
    assert programs.song_features(spark, song_file)["rows"].count() == 10
    found = programs.ridge_search(spark, song_file)
    assert found["grid"].count() == 49 and found["best"].count() == 1
    assert programs.descent(spark, song_file)["history"].count() == 100


def test_summary_from_one_scan_equals_the_questions(spark, folder):
    from linefit.plans import songs

    lines = T.damaged_song_lines(spark, folder)
    lines = lines.union(spark.createDataFrame([("NaN" + ",1" * 12,)], "value string"))
    one = songs.questions_from_counts(songs.counted_lines(lines))
    each = songs.questions(songs.songs_from_lines(lines))
    for name, table in each.items():
        a, b = (sorted(tuple(r) for r in t.collect()) for t in (one[name], table))
        assert [pytest.approx(r) for r in b] == a, name
    rejects = {r.reason: r["count"] for r in one["rejected_lines"].collect()}
    assert sum(rejects.values()) == songs.rejected(lines).count() and len(rejects) == 3
    empty = songs.questions_from_counts(songs.counted_lines(lines.limit(0)))
    assert empty["song_count"].first()[0] == 0
    assert tuple(empty["year_min_max_avg"].first()) == (None, None, None)


def test_damaged_lines_do_not_stop_a_program(spark, folder):
    path = staging.write_lines(T.damaged_song_lines(spark, folder), "damaged")
    assert programs.descent(spark, path)["errors"].count() == 2


def test_wide_csv(spark, folder):
    path = staging.write_lines(T.wide_lines(spark, folder), "wide", T.CSV_HEADER)
    tables = programs.wide_csv(spark, path)
    assert tables["weights"].count() == 6
    assert {r.side for r in tables["errors"].collect()} == {"train", "test"}


def test_bank(spark, folder):
    path = staging.write_lines(T.bank_lines(spark, folder, True), "bank", T.BANK_HEADER)
    ages = [r.age for r in programs.bank_ages(spark, path)["ages"].collect()]
    assert ages == sorted(ages) and max(ages) < K.AGE_BOUND


@pytest.mark.parametrize("by_mllib", [False, True])
def test_elastic_net_is_optimal(spark, folder, by_mllib):
    """The penalised gradient vanishes for used features and is small for the others."""
    rows = T.charge_rows(spark, folder)
    train = regression.hash_split(rows, K.SPLIT_7_3, T.LINE_KEYS)[0]
    data = train.select("features", "label").toPandas()
    x, y = np.array(data.features.tolist()), data.label.to_numpy()
    if by_mllib:
        model, _ = regression.elastic_net_by_mllib(rows, T.LINE_KEYS, max_iter=100)
        coefficients, near = regression.fitted_regression(model).coefficients.toArray(), 1e-4
    else:
        model, _ = regression.elastic_net(rows, T.LINE_KEYS)
        coefficients, near = model.weights, 1e-9
    w = coefficients * x.std(axis=0) / y.std()
    z, t = (x - x.mean(axis=0)) / x.std(axis=0), (y - y.mean()) / y.std()
    strength, share = K.ELASTIC_NET["regParam"] / y.std(), K.ELASTIC_NET["elasticNetParam"]
    slope = z.T @ (z @ w - t) / len(y) + strength * (1 - share) * w
    for s, v in zip(slope, w):
        if v:
            assert s + np.sign(v) * strength * share == pytest.approx(0, abs=near)
        else:
            assert abs(s) <= strength * share + near


@pytest.mark.parametrize("program", [
    regression.gradient_descent, regression.tuned_ridge, regression.tuned_degree_two_ridge,
    regression.elastic_net,
])
def test_fit_and_errors_take_one_job_and_equal_the_scored_rows(spark, folder, jobs_of, program):
    rows = T.charge_rows(spark, folder)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        (model, errors), jobs = jobs_of(lambda: program(rows, T.LINE_KEYS))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert jobs == 1
    if program is regression.tuned_degree_two_ridge:
        rows = regression.S.DegreeTwo(inputCol="features", outputCol="products").transform(rows)
    tuned = program in (regression.tuned_ridge, regression.tuned_degree_two_ridge)
    weights = K.SPLIT_7_3 if program is regression.elastic_net else K.SPLIT_9_1
    seed = K.TUNING_SEED if tuned else 0
    scored = regression._errors(model, rows, weights, T.LINE_KEYS, seed)
    a, b = ({r.side: r.value for r in t.collect()} for t in (errors, scored))
    assert a.keys() == b.keys() == {"train", "test"}
    assert a == pytest.approx(b, rel=1e-9)


def test_errors_of_a_perfect_fit_come_from_the_rows(spark):
    rows = spark.range(2000).selectExpr(
        "id", "array(id / 2000, 1.0D) as features", "id / 4000 + 0.25D as label"
    )
    model, errors = regression.gradient_descent(rows, ["id"])
    exact = regression._errors(model, rows, K.SPLIT_9_1, ["id"], 0)
    a, b = ({r.side: r.value for r in t.collect()} for t in (errors, exact))
    assert a == pytest.approx(b, rel=1e-6)


def test_wide_descent_program(spark, folder, monkeypatch):
    rows = T.price_rows(spark, folder)
    expected, errors = regression.gradient_descent(rows, T.LINE_KEYS)
    monkeypatch.setattr(K, "GRADIENT_ITERATIONS", 3)
    model, wide_errors = regression.gradient_descent(rows, T.LINE_KEYS, solver="rows")
    np.testing.assert_allclose(model.history, expected.history[:3], rtol=1e-9)
    assert wide_errors.count() == errors.count() == 2
