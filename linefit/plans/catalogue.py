"""One query per operator over the given tables; ``catalogue_sql`` holds their SQL twins.

Doubles are rounded to six places and vectors come as rows ``(…, idx, value)``, so that two
engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.functions import fields as X
from linefit.functions import vectors as V
from linefit.operators import stages as S
from linefit.operators import summary
from linefit.operators.evaluate import rmse_table
from linefit.operators.linear import (
    ElasticNetRegression,
    GradientDescentModel,
    GradientDescentRegression,
    RidgePath,
    RidgeRegression,
    gradient,
    gradient_terms,
)
from linefit.operators.moments import collect_moments, finite_rows
from linefit.operators.split import hash_split, with_part
from linefit.operators.tuning import RidgeGridSearch, parameter_grid
from linefit.plans import bank, regression, songs
from linefit.plans import fixed_values as K
from linefit.plans import testviews as T
from linefit.sources import delimited, memory, multiline, splits, staging, text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SCORE_WEIGHTS = [0.5, 0.25, 0.125]
PART_AGE_BOUND = 40
EMBEDDING_WIDTH = 64


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(c: Column | str, places: int = 6) -> Column:
    return T.plain(F.round(c, places))


def by_index(df: DataFrame, vector: str, width: int) -> DataFrame:
    """Count, sum and largest element per vector position; another width is an error."""

    def measures(x: Column) -> list[Column]:
        return [
            F.count(x).alias("count"),
            rounded(F.sum(x)).alias("total"),
            rounded(F.max(x)).alias("largest"),
        ]

    if width > V.WRITTEN_OUT:  # so many aggregates would take longer to compile than to run
        v = V.checked(F.col(vector), width)
        elements = df.select(F.posexplode(v).alias("idx", "value"))
        return elements.groupBy("idx").agg(*measures(F.col("value")))
    positions = [
        F.struct(F.lit(j).alias("idx"), *measures(V.element(V.checked(F.col(vector), width), j)))
        for j in range(width)
    ]
    return df.agg(F.array(*positions).alias("positions")).select(F.inline("positions"))


# --- summaries ----------------------------------------------------------------------------


def _question(name: str, by_sql: bool) -> Query:
    def build(spark, folder):
        table = T.songs(spark, folder)
        answers = songs.questions_by_sql(spark, table) if by_sql else songs.questions(table)
        if name == "year_min_max_avg":
            return answers[name].withColumn("avg", rounded("avg"))
        return answers[name]

    return build


for _name in ("song_count", "song_count_1998_2000", "year_min_max_avg", "songs_per_year"):
    QUERIES[_name] = _question(_name, by_sql=False)
    QUERIES[f"{_name}_sql"] = _question(_name, by_sql=True)


@query
def keys_below_bound_ordered(spark, folder):
    return bank.customers_per_age(T.bank(spark, folder), PART_AGE_BOUND)


@query
def keys_below_bound_ordered_sql(spark, folder):
    return bank.customers_per_age_sql(spark, T.bank(spark, folder), PART_AGE_BOUND)


@query
def preview_top_n(spark, folder):
    orders = T.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return summary.first_rows(orders, 10, F.desc("o_totalprice"), "o_orderkey")


# --- text and CSV -------------------------------------------------------------------------


@query
def csv_headerless_songs(spark, folder):
    path = staging.write_lines(T.song_lines(spark, folder), "songs-csv")
    names = [f"_c{i}" for i in range(K.LINE_WIDTH)]
    records = delimited.read_delimited(spark, path, names, header=False)
    fields = F.array(*names)
    return records.select(
        X.whole(X.to_double(X.field(fields, 0))).alias("year"),
        *[rounded(X.to_double(X.field(fields, i))).alias(f"f{i}") for i in (1, 2, 3)],
    )


@query
def text_lines_songs(spark, folder):
    path = staging.write_lines(T.song_lines(spark, folder), "songs-text")
    table = songs.songs_from_lines(text.read_lines(spark, path))
    return table.select("year", *[rounded(f).alias(f) for f in ("f1", "f2", "f3")])


@query
def lines_accepted_per_year(spark, folder):
    return summary.count_per_key(
        songs.songs_from_lines(T.damaged_song_lines(spark, folder)), "year"
    )


@query
def lines_rejected_per_reason(spark, folder):
    return summary.count_per_key(
        songs.rejected(T.damaged_song_lines(spark, folder)), text.REASON
    )


@query
def line_counts(spark, folder):
    return songs.counted_lines(T.damaged_song_lines(spark, folder))


@query
def rejects_non_finite(spark, folder):
    """Lines with NaN or an infinite number are rejected as such, and the others are kept."""
    lines = T.non_finite_song_lines(spark, folder)
    kept = songs.good_lines(lines, finite=True).agg(F.lit("none").alias("reason"), F.count("*").alias("count"))
    rejected = songs.rejected(lines, finite=True)
    return summary.count_per_key(rejected, text.REASON).unionByName(kept)


@query
def bank_rejected_per_reason(spark, folder):
    path = staging.write_lines(T.damaged_bank_lines(spark, folder), "bank-csv", T.BANK_HEADER)
    return bank.rejected_records(spark, path)


@query
def bank_lines_rejected(spark, folder):
    reasons = bank.with_reason(T.damaged_bank_lines(spark, folder))
    return summary.count_per_key(
        reasons.select(F.coalesce(text.REASON, F.lit("none")).alias("reason")), "reason"
    )


@query
def wide_csv_rejected(spark, folder):
    path = staging.write_lines(T.odd_wide_lines(spark, folder), "wide-csv", T.CSV_HEADER)
    return regression.wide_csv_rejects(delimited.checked_records(spark, path))


@query
def csv_drop_malformed(spark, folder):
    path = staging.write_lines(T.wide_lines(spark, folder), "wide-csv", T.CSV_HEADER)
    records = delimited.read_delimited(spark, path)
    return summary.count_per_key(records, "ArtistName")


@query
def csv_rejected_records(spark, folder):
    path = staging.write_lines(T.wide_lines(spark, folder), "wide-csv", T.CSV_HEADER)
    records = delimited.rejected_records(spark, path, K.CSV_COLUMNS)
    fields = F.size(X.split_fields(F.col("record"))).alias("fields")
    return records.groupBy(fields).agg(F.count("*").alias("count"))


@query
def delimited_quoted_bank(spark, folder):
    lines = T.bank_lines(spark, folder, delimiter_in_job=True)
    return bank.read_bank(spark, staging.write_lines(lines, "bank-csv", T.BANK_HEADER))


@query
def quoted_multiline_records(spark, folder):
    """Jobs with line breaks and doubled quotes inside their field."""
    lines = T.bank_lines(spark, folder, delimiter_in_job=True, between='\n"";\n\n')
    path = staging.write_lines(lines, "bank-records")
    names = ["age", "job", "marital", "education", "default", "balance"]
    return bank.customers(multiline.read_delimited(spark, path, names, header=False, separator=";"))


@query
def bank_lines_by_position(spark, folder):
    path = staging.write_lines(T.bank_lines(spark, folder), "bank-text", T.BANK_HEADER)
    return bank.bank_from_lines(text.read_lines(spark, path))


@query
def wide_select_drop_pack(spark, folder):
    packed = regression.packed_songs(T.wide_records(spark, folder))
    return by_index(
        packed.select(X.to_doubles(F.col("values")).alias("numbers")), "numbers",
        len(K.CSV_PACKED),
    )


# --- feature preparation ------------------------------------------------------------------


@query
def tokenize_lines(spark, folder):
    tokenizer = S.LineTokenizer(inputCol="text", outputCol="tokens")
    tokenized = tokenizer.transform(T.table(spark, folder, "documents"))
    return tokenized.select(
        "doc_id",
        F.size("tokens").alias("tokens"),
        F.length(F.array_join("tokens", "")).alias("characters"),
    )


@query
def tokens_to_numbers(spark, folder):
    stages = [
        S.LineTokenizer(inputCol="value", outputCol="texts"),
        S.ToNumbers(inputCol="texts", outputCol="numbers"),
    ]
    lines = T.song_lines(spark, folder)
    return by_index(PipelineModel(stages).transform(lines), "numbers", K.LINE_WIDTH)


@query
def slice_label_features(spark, folder):
    rows = regression.prepared(T.song_lines(spark, folder), regression.line_stages())
    return rows.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count("*").alias("count"),
        *[
            rounded(F.sum(V.element(F.col("features"), i))).alias(f"f{i + 1}")
            for i in range(len(K.FEATURE_FIELDS))
        ],
    )


@query
def label_shift_min(spark, folder):
    lines = T.song_lines(spark, folder)
    rows = regression.prepare_lines(lines).transform(lines)
    return summary.count_per_key(rows, "label")


@query
def label_shift_min_lazy(spark, folder):
    table = T.songs(spark, folder).select(F.col("year").cast("double").alias("year"))
    shifted = table.select((F.col("year") - summary.minimum(table, "year")).alias("label"))
    return summary.count_per_key(shifted, "label")


@query
def row_split_counts(spark, folder):
    """Every row drawn by itself: its key is its place in the file."""
    rows = splits.addressed_rows(T.table(spark, folder, "lineitem"))
    parted = with_part(rows, [0.7, 0.2, 0.1], [splits.FILE, splits.OFFSET], K.TUNING_SEED)
    return parted.groupBy("part").agg(
        F.count("*").alias("count"), F.sum("l_partkey").alias("part_keys")
    )


@query
def label_shift_const(spark, folder):
    stages = [
        S.ColumnFunction(
            inputCol="vector", outputCol="number", function=lambda v: V.element(v, 0)
        ),
        S.LabelShift(inputCol="number", outputCol="label", offset=float(K.FIRST_YEAR)),
        S.ColumnFunction(inputCol="label", outputCol="decade", function=lambda x: F.floor(x / 10)),
    ]
    vectors = T.songs(spark, folder).select(F.array(F.col("year").cast("double")).alias("vector"))
    rows = PipelineModel(stages).transform(vectors)
    return rows.groupBy("label", "decade").agg(F.count("*").alias("count"))


@query
def poly2_column_sums(spark, folder):
    rows = S.DegreeTwo(inputCol="features", outputCol="products").transform(
        T.price_rows(spark, folder)
    )
    return by_index(rows, "products", V.degree_two_width(3))


@query
def poly2_wide_sums(spark, folder):
    """All 2,144 products of the 64 numbers of an embedding."""
    rows = S.DegreeTwo(inputCol="features", outputCol="products").transform(
        T.embedding_rows(spark, folder)
    )
    return by_index(rows, "products", V.degree_two_width(EMBEDDING_WIDTH))


@query
def finite_rows_kept(spark, folder):
    """Every third vector has a NaN, a null or one element too few."""
    rows = T.damaged_embedding_rows(spark, folder)
    kept = finite_rows(rows, width=EMBEDDING_WIDTH)
    return kept.groupBy("vec_id").agg(F.count("*").alias("count"))


# --- vectors ------------------------------------------------------------------------------


@query
def vector_scale_add_fill(spark, folder):
    rows = T.embedding_rows(spark, folder)
    v = F.col("features")
    return by_index(
        rows.select(V.add(V.scale(v, 2.0), V.fill(F.size(v), 1.0)).alias("moved")),
        "moved", EMBEDDING_WIDTH,
    )


@query
def embedding_dot_score(spark, folder):
    rows = T.embedding_rows(spark, folder)
    weights = [(j % 5 - 2) / 10 for j in range(EMBEDDING_WIDTH)]
    v = F.col("features")
    return rows.select(
        "vec_id",
        rounded(V.dot_weights(v, weights)).alias("score"),
        rounded(V.dot(v, F.reverse(v))).alias("mirrored"),
    )


@query
def embedding_sum_by_label(spark, folder):
    table = T.table(spark, folder, "embeddings")
    sums = summary.vector_sum(table, "embedding", by=["label"])
    return sums.select("label", "idx", rounded("value").alias("value"))


# --- splitting and evaluation -------------------------------------------------------------


@query
def hash_split_counts(spark, folder):
    rows = with_part(
        T.table(spark, folder, "lineitem"), [0.7, 0.2, 0.1], T.LINE_KEYS, K.TUNING_SEED
    )
    return rows.groupBy("part").agg(
        F.count("*").alias("count"), F.sum("l_partkey").alias("part_keys")
    )


def _scored(spark, folder) -> DataFrame:
    rows = T.price_rows(spark, folder)
    score = V.dot_weights(F.col("features"), SCORE_WEIGHTS)
    return rows.withColumn("prediction", score)


@query
def squared_error_total(spark, folder):
    total = summary.squared_error_sum(_scored(spark, folder), "label", "prediction")
    return total.select(rounded("squared_error_sum", 4).alias("squared_error_sum"))


@query
def rmse_of_scored_rows(spark, folder):
    table = rmse_table(_scored(spark, folder))
    return table.select("metric", rounded("value").alias("value"))


# --- gradient descent ---------------------------------------------------------------------


@query
def gd_gradient_at_zero(spark, folder):
    g = gradient(T.price_rows(spark, folder), [0.0, 0.0, 0.0])
    return g.select("idx", rounded("value", 4).alias("value"))


@query
def gd_gradient_terms(spark, folder):
    terms = gradient_terms(T.price_rows(spark, folder), SCORE_WEIGHTS)
    sums = summary.vector_sum(terms, "gradient_term", by=["l_linenumber"])
    return sums.select("l_linenumber", "idx", rounded("value", 4).alias("value"))


def _descended(spark, folder):
    return GradientDescentRegression().fit(T.price_rows(spark, folder))


@query
def gd_weights(spark, folder):
    table = _descended(spark, folder).weights_table(spark)
    return table.select("idx", rounded("value").alias("value"))


@query
def gd_history(spark, folder):
    table = _descended(spark, folder).history_table(spark)
    return table.select("iter", rounded("rmse").alias("rmse"))


@query
def gd_wide_history(spark, folder):
    model = GradientDescentRegression().fit(T.embedding_rows(spark, folder))
    return model.history_table(spark).select("iter", rounded("rmse").alias("rmse"))


@query
def gd_wide_weights(spark, folder):
    model = GradientDescentRegression().fit(T.embedding_rows(spark, folder))
    return model.weights_table(spark).select("idx", rounded("value").alias("value"))


@query
def gd_rows_history(spark, folder):
    """Every update from the rows themselves."""
    model = GradientDescentRegression(solver="rows").fit(T.price_rows(spark, folder))
    return model.history_table(spark).select("iter", rounded("rmse").alias("rmse"))


@query
def gd_rows_errors(spark, folder):
    """The errors of the history, each from the rows by the weights before its update."""
    rows = T.price_rows(spark, folder)
    model = GradientDescentRegression(numIterations=3).fit(rows)
    return model.history_table(spark).select("iter", rounded("rmse").alias("rmse"))


@query
def gd_perfect_history(spark, folder):
    """Errors of the program's training part, which come down to the last digits of the sums."""
    model, _ = regression.gradient_descent(T.perfect_rows(spark, folder), T.LINE_KEYS)
    scaled = model.history_table(spark).withColumn("rmse", F.col("rmse") * 1e6)
    return scaled.select("iter", rounded("rmse", 4).alias("rmse"))


@query
def pipeline_copy_score(spark, folder):
    """A copied estimator with another number of updates, found again among the stages."""
    rows = T.price_rows(spark, folder)
    base = GradientDescentRegression()
    copied = base.copy({base.numIterations: 5})
    fitted = Pipeline(stages=[copied.setPredictionCol("guess")]).fit(rows)
    model = S.stage_of(fitted, GradientDescentModel)
    table = model.weights_table(spark)
    return table.select("idx", rounded("value").alias("value"))


def _train_test(spark, folder):
    return hash_split(T.price_rows(spark, folder), K.SPLIT_9_1, T.LINE_KEYS)


@query
def gd_test_predictions(spark, folder):
    train, test = _train_test(spark, folder)
    scored = GradientDescentRegression().fit(train).transform(test)
    return scored.select(
        *T.LINE_KEYS, rounded("label", 8).alias("label"), rounded("prediction").alias("prediction")
    )


@query
def gd_test_rmse(spark, folder):
    _, errors = regression.gradient_descent(T.price_rows(spark, folder), T.LINE_KEYS)
    return errors.select("side", "metric", rounded("value").alias("value"))


@query
def gd_from_lines(spark, folder):
    """Lines → typed fields → shifted label → split → descent → errors, with the history."""
    lines = songs.good_lines(T.song_lines(spark, folder, T.LINE_KEYS))
    rows = regression.prepared(lines, regression.number_stages("numbers"))
    model, errors = regression.gradient_descent(rows, T.LINE_KEYS)
    history = model.history_table(spark).select(
        F.lit("history").alias("series"), "iter", F.col("rmse").alias("value")
    )
    final = errors.select("side", F.lit(len(model.history)).alias("iter"), "value")
    return history.union(final).withColumn("value", rounded("value"))


# --- ridge and grid search ----------------------------------------------------------------


def _one_feature(spark, folder):
    stage = S.VectorPicker(inputCol="features", outputCol="price", indices=[0])
    return stage.transform(T.charge_rows(spark, folder))


@query
def ols_1d(spark, folder):
    model = RidgeRegression(featuresCol="price").fit(_one_feature(spark, folder))
    rows = [("slope", float(model.weights[0])), ("intercept", model.intercept)]
    table = memory.from_rows(spark, rows, "name string, value double")
    return table.select("name", rounded("value").alias("value"))


@query
def ols_train_rmse(spark, folder):
    rows = _one_feature(spark, folder)
    scored = RidgeRegression(featuresCol="price").fit(rows).transform(rows)
    return rmse_table(scored).select("metric", rounded("value").alias("value"))


@query
def grid_train_rmse(spark, folder):
    rows = collect_moments(T.charge_rows(spark, folder))[None]
    path = RidgePath(rows)
    table = memory.from_rows(
        spark,
        [
            (reg, iterations, rows.rmse(*path.solve(reg)))
            for reg, iterations in parameter_grid(K.REG_PARAMS, K.MAX_ITERS)
        ],
        "regParam double, maxIter int, rmse double",
    )
    return table.select("regParam", "maxIter", rounded("rmse").alias("rmse"))


@query
def ridge_near_perfect_rmse(spark, folder):
    """A label that is a feature but for a term of 1e-9: its error is in the last digits."""
    rows = T.near_perfect_rows(spark, folder)
    model = RidgeRegression().fit(rows)
    return memory.from_rows(spark, [(model.train_rmse * 1e9,)], "value double").select(
        rounded("value", 3).alias("value")
    )


@query
def raw_year_moments(spark, folder):
    """Deviation of a raw year, which is small beside its mean."""
    rows = T.songs(spark, folder).select(
        F.array(F.col("year").cast("double")).alias("features", metadata=V.width_metadata(1)),
        F.col("f1").alias("label"),
    )
    found = collect_moments(rows)[None]
    table = memory.from_rows(
        spark, [(found.n, float(found.mean[0]), float((found.products[0, 0] / found.n) ** 0.5))],
        "count long, mean double, deviation double",
    )
    return table.select("count", rounded("mean").alias("mean"), rounded("deviation").alias("deviation"))


def _search(features: str = "features", solver: str = "auto") -> RidgeGridSearch:
    return RidgeGridSearch(
        featuresCol=features, regParams=K.REG_PARAMS, maxIters=K.MAX_ITERS,
        keyCols=T.LINE_KEYS, solver=solver,
    )


def _products(spark, folder):
    stage = S.DegreeTwo(inputCol="features", outputCol="products")
    return stage.transform(T.charge_rows(spark, folder))


@query
def ridge_cv_table(spark, folder):
    model = _search().fit(T.charge_rows(spark, folder))
    return model.fold_table(spark).withColumn("rmse", rounded("rmse"))


@query
def ridge_rows_cv_table(spark, folder):
    """The same errors from one aggregate per iteration, without a matrix of products."""
    model = _search(solver="rows").fit(T.charge_rows(spark, folder))
    return model.fold_table(spark).withColumn("rmse", rounded("rmse"))


@query
def ridge_wide_moments_weights(spark, folder):
    """A wide product matrix, whose rows the tasks' sums are added by in two steps."""
    model = RidgeRegression(regParam=0.1).fit(T.embedding_rows(spark, folder))
    return model.weights_table(spark).select("idx", rounded("value").alias("value"))


@query
def ridge_wide_rows_weights(spark, folder):
    model = RidgeRegression(regParam=0.1, solver="rows").fit(T.embedding_rows(spark, folder))
    return model.weights_table(spark).select("idx", rounded("value").alias("value"))


@query
def ridge_shifted_cv_table(spark, folder):
    """Nine products of features: the strengths of a fold from one Krylov space."""
    model = _search("products", solver="rows").fit(_products(spark, folder))
    return model.mean_table(spark).withColumn("rmse", rounded("rmse"))


@query
def ridge_sketched_weights(spark, folder):
    """The 2,144 products of the numbers of an embedding, by a sketch of the rows."""
    rows = S.DegreeTwo(inputCol="features", outputCol="products").transform(T.embedding_rows(spark, folder))
    model = RidgeRegression(regParam=0.1, featuresCol="products", solver="sketched").fit(rows)
    return model.weights_table(spark).select("idx", rounded("value").alias("value"))


@query
def ridge_cv_best(spark, folder):
    model = _search().fit(T.charge_rows(spark, folder))
    return model.best_table(spark).withColumn("train_rmse", rounded("train_rmse"))


@query
def ridge_cv_weights(spark, folder):
    model = _search().fit(T.charge_rows(spark, folder))
    return model.weights_table(spark).withColumn("value", rounded("value"))


@query
def ridge_cv_errors(spark, folder):
    _, errors = regression.tuned_ridge(T.charge_rows(spark, folder), T.LINE_KEYS)
    return errors.select("side", "metric", rounded("value").alias("value"))


@query
def poly_ridge_cv_table(spark, folder):
    model = _search("products").fit(_products(spark, folder))
    return model.mean_table(spark).withColumn("rmse", rounded("rmse"))


@query
def poly_ridge_cv_best(spark, folder):
    model = _search("products").fit(_products(spark, folder))
    return model.best_table(spark).withColumn("train_rmse", rounded("train_rmse"))


@query
def poly_ridge_cv_errors(spark, folder):
    _, errors = regression.tuned_degree_two_ridge(T.charge_rows(spark, folder), T.LINE_KEYS)
    return errors.select("side", "metric", rounded("value").alias("value"))


# --- elastic net --------------------------------------------------------------------------


@query
def elastic_net_errors(spark, folder):
    _, errors = regression.elastic_net(T.charge_rows(spark, folder), T.LINE_KEYS)
    return errors.select("side", "metric", rounded("value").alias("value"))


@query
def elastic_net_weights(spark, folder):
    model, _ = regression.elastic_net(T.charge_rows(spark, folder), T.LINE_KEYS)
    return model.weights_table(spark).withColumn("value", rounded("value"))


@query
def elastic_net_rows_weights(spark, folder):
    rows = T.charge_rows(spark, folder)
    model, _ = regression.elastic_net(rows, T.LINE_KEYS, solver="rows")
    return model.weights_table(spark).withColumn("value", rounded("value"))


@query
def elastic_net_consensus_weights(spark, folder):
    """From factors of the tasks' rows, which rounds read in place of the rows."""
    rows = T.charge_rows(spark, folder)
    model, _ = regression.elastic_net(rows, T.LINE_KEYS, solver="consensus")
    return model.weights_table(spark).withColumn("value", rounded("value"))


@query
def elastic_net_predictions(spark, folder):
    rows = T.charge_rows(spark, folder)
    model, _ = regression.elastic_net(rows, T.LINE_KEYS)
    _, test = hash_split(rows, K.SPLIT_7_3, T.LINE_KEYS)
    return model.transform(test).select(
        *T.LINE_KEYS,
        rounded("label", 12).alias("label"),
        rounded("prediction").alias("prediction"),
    )


@query
def elastic_net_errors_mllib(spark, folder):
    """MLlib stops within its tolerance, so fewer places are compared."""
    _, errors = regression.elastic_net_by_mllib(T.charge_rows(spark, folder), T.LINE_KEYS)
    return errors.select("side", "metric", rounded("value", 4).alias("value"))


@query
def wide_csv_regression(spark, folder):
    path = staging.write_lines(T.wide_lines(spark, folder), "wide-csv", T.CSV_HEADER)
    model, errors = regression.wide_csv_regression(delimited.read_delimited(spark, path))
    weights = model.weights_table(spark).select(
        F.concat(F.lit("weight "), F.col("idx")).alias("name"), "value"
    )
    named = errors.select(F.concat_ws(" ", "side", "metric").alias("name"), "value")
    return named.union(weights).withColumn("value", rounded("value"))


@query
def wide_csv_regression_mllib(spark, folder):
    """Three of MLlib's steps come near the settled weights: fewer places are compared."""
    path = staging.write_lines(T.wide_lines(spark, folder), "wide-csv", T.CSV_HEADER)
    _, errors = regression.wide_csv_regression_by_mllib(delimited.read_delimited(spark, path))
    return errors.select("side", "metric", rounded("value", 3).alias("value"))
