"""What the physical plans must and must not contain."""

import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from linefit.operators import summary
from linefit.operators.linear import GradientDescentModel
from linefit.operators.moments import collect_moments
from linefit.operators.split import with_part
from linefit.plans import catalogue
from linefit.plans import testviews as T
from linefit.sources import memory, staging

NATIVE = [
    "songs_per_year", "keys_below_bound_ordered", "preview_top_n", "lines_accepted_per_year",
    "lines_rejected_per_reason", "tokenize_lines", "tokens_to_numbers", "slice_label_features",
    "poly2_column_sums", "wide_select_drop_pack", "embedding_dot_score",
    "embedding_sum_by_label", "hash_split_counts", "rmse_of_scored_rows", "gd_gradient_terms",
    "gd_test_predictions", "elastic_net_predictions", "label_shift_min_lazy",
]


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_no_join_no_cache(spark, folder, name):
    plan = plan_of(catalogue.QUERIES[name](spark, folder))
    for word in ("Python", "UDF", "Join", "InMemory", "Cartesian", "Window"):
        assert word not in plan.replace("InMemoryFileIndex", ""), word


def test_only_used_columns_are_read(spark, folder):
    plan = catalogue.QUERIES["songs_per_year"](spark, folder)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_shipdate:timestamp_ntz>" in plan


def test_filters_reach_the_scan_through_a_split(spark, folder):
    parts = with_part(T.table(spark, folder, "lineitem"), [0.5, 0.3, 0.2], T.LINE_KEYS)
    plan = plan_of(parts.filter(F.col("l_quantity") > 49).select("part"))
    assert "GreaterThan(l_quantity,49.0)" in plan


def test_preview_keeps_the_best_of_each_task(spark, folder):
    assert "TakeOrderedAndProject" in plan_of(catalogue.QUERIES["preview_top_n"](spark, folder))


def test_counts_are_combined_before_the_shuffle(spark, folder):
    plan = plan_of(summary.count_per_key(T.songs(spark, folder), "year"))
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("partial_count")


def test_moments_do_not_read_other_columns(spark, folder, monkeypatch):
    plans = []
    import pyspark.sql.classic.dataframe as classic

    original = classic.DataFrame.collect
    monkeypatch.setattr(
        classic.DataFrame, "collect", lambda df: (plans.append(plan_of(df)), original(df))[1]
    )
    collect_moments(T.price_rows(spark, folder))
    assert "l_orderkey" not in plans[0] and "l_quantity" in plans[0]


def test_scoring_reads_only_its_features(spark, folder):
    model = GradientDescentModel([0.5, 0.25, 0.125])
    plan = plan_of(model.transform(T.price_rows(spark, folder)).select("prediction"))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_tax:double>" in plan


def test_rows_and_views(spark):
    table = memory.from_rows(spark, [(1, "a"), (2, None)], "id int, name string")
    memory.register_view(table, "given_rows")
    assert spark.sql("SELECT count(*) AS n, count(name) AS m FROM given_rows").first() == (2, 1)


def test_written_table_keeps_rows_and_metadata(spark, folder):
    rows = T.price_rows(spark, folder)
    again = staging.write_table(rows, "t")
    assert again.schema["features"].metadata == rows.schema["features"].metadata
    assert again.exceptAll(rows).count() == 0 and again.count() == rows.count()
