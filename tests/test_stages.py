import pytest
from plan_text import plan_of
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PolynomialExpansion, RegexTokenizer, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from linefit.functions import vectors as V
from linefit.operators import stages as S
from linefit.plans import regression
from linefit.plans import testviews as T


def test_tokenizer_equals_mllib(spark, folder):
    table = T.table(spark, folder, "documents").select("text")
    for pattern, length in ((",", 1), (r"\s+", 3), (r"[,.;]\s*", 1)):
        ours = S.LineTokenizer(
            inputCol="text", outputCol="a", pattern=pattern, minTokenLength=length
        )
        theirs = RegexTokenizer(
            inputCol="text", outputCol="b", pattern=pattern, minTokenLength=length
        )
        both = theirs.transform(ours.transform(table))
        assert both.filter(F.col("a") != F.col("b")).count() == 0


def test_picker_equals_mllib(spark, folder):
    rows = T.embedding_rows(spark, folder).withColumn("v", array_to_vector("features"))
    indices = [5, 0, 63]
    ours = S.VectorPicker(inputCol="features", outputCol="a", indices=indices).transform(rows)
    from_vector = S.VectorPicker(inputCol="v", outputCol="c", indices=indices).transform(ours)
    both = VectorSlicer(inputCol="v", outputCol="b", indices=indices).transform(from_vector)
    different = (F.col("a") != vector_to_array("b")) | (F.col("c") != F.col("a"))
    assert both.filter(different).count() == 0


@pytest.mark.parametrize("width", [1, 3, V.WRITTEN_OUT + 4])
def test_degree_two_equals_mllib(spark, folder, width):
    rows = T.embedding_rows(spark, folder)
    picked = S.VectorPicker(inputCol="features", outputCol="x", indices=list(range(width)))
    ours = S.DegreeTwo(inputCol="x", outputCol="a").transform(picked.transform(rows))
    assert V.known_width(ours, "a") == V.degree_two_width(width)
    both = PolynomialExpansion(inputCol="v", outputCol="b", degree=2).transform(
        ours.withColumn("v", array_to_vector("x"))
    )
    gap = F.zip_with("a", vector_to_array("b"), lambda x, y: F.abs(x - y))
    worst, width_a = both.select(
        F.max(F.array_max(gap)).alias("gap"), F.max(F.size("a")).alias("width")
    ).first()
    assert worst < 1e-12 and width_a == V.degree_two_width(width)


def test_preparation_is_expressions_only(spark, folder):
    lines = T.song_lines(spark, folder)
    rows = regression.prepared(lines, regression.line_stages()).select("label", "features")
    plan = plan_of(rows)
    assert "UDF" not in plan and "Python" not in plan
    assert V.known_width(rows, "features") == 3


def test_tokenized_and_positional_preparation_agree_without_gaps(spark, folder):
    lines = T.song_lines(spark, folder)
    a, b = (
        regression.prepared(lines, regression.line_stages(tokenize=t)).select("label", "features")
        for t in (True, False)
    )
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_minimum_becomes_zero(spark, folder):
    lines = T.song_lines(spark, folder)
    rows = regression.prepare_lines(lines).transform(lines)
    assert rows.agg(F.min("label")).first()[0] == 0.0


def test_minimum_of_nothing(spark):
    empty = spark.createDataFrame([], "x double")
    with pytest.raises(ValueError):
        S.MinimumLabelShift(inputCol="x", outputCol="y").fit(empty)


def test_stages_survive_saving(spark, folder, tmp_path):
    lines = T.song_lines(spark, folder)
    model = regression.prepare_lines(lines, tokenize=True)
    model.write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a, b = (m.transform(lines).select("label", "features") for m in (model, again))
    assert a.exceptAll(b).count() == 0
    Pipeline(stages=regression.line_stages()).write().save(str(tmp_path / "p"))
    assert len(Pipeline.load(str(tmp_path / "p")).getStages()) == 6


def test_function_stage_is_an_expression(spark):
    stage = S.ColumnFunction(inputCol="id", outputCol="sq", function=lambda c: c * c)
    df = stage.transform(spark.range(4))
    assert [r.sq for r in df.collect()] == [0, 1, 4, 9]
    assert "UDF" not in plan_of(df)


def test_stage_of():
    model = PipelineModel([S.LabelShift(offset=1.0), S.FirstElement()])
    assert isinstance(S.stage_of(model, S.FirstElement), S.FirstElement)
    with pytest.raises(LookupError):
        S.stage_of(model, S.DegreeTwo)


def test_functions_are_saved_as_their_expression(spark, folder, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.sql import functions as F

    stages = [
        S.ColumnFunction(inputCol="vector", outputCol="number", function=lambda v: F.get(v, F.lit(0))),
        S.LabelShift(inputCol="number", outputCol="label", offset=1922.0),
        S.ColumnFunction(inputCol="label", outputCol="decade", function=lambda x: F.floor(x / 10)),
        S.ColumnFunction(inputCol="label", outputCol="name", function=lambda x: F.concat(F.lit("it's `"), x.cast("string"))),
    ]
    table = spark.createDataFrame([([1999.0],), ([2003.5],), (None,)], "vector array<double>")
    model = PipelineModel(stages)
    wanted = model.transform(table).collect()
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    assert loaded.transform(table).collect() == wanted
    renamed = loaded.stages[0].copy().setInputCol("other name")
    rows = renamed.transform(table.withColumnRenamed("vector", "other name")).select("number").collect()
    assert [r[0] for r in rows] == [1999.0, 2003.5, None]
    loaded.write().overwrite().save(str(tmp_path / "again"))
    assert PipelineModel.load(str(tmp_path / "again")).transform(table).collect() == wanted
    assert "Python" not in plan_of(loaded.transform(table))


def test_functions_without_sql_text_are_not_saved(spark, tmp_path):
    from pyspark.sql import functions as F

    plus = F.udf(lambda x: x + 1, "double")
    with pytest.raises(ValueError, match="no SQL text"):
        S.ColumnFunction(inputCol="a", outputCol="b", function=plus).save(str(tmp_path / "udf"))
    with pytest.raises(ValueError, match="needs a function"):
        S.ColumnFunction(inputCol="id", outputCol="b").transform(spark.range(1))
