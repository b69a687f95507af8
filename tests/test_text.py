import pytest
from plan_text import plan_of
from pyspark.sql import functions as F

from linefit.functions import fields as X
from linefit.plans import songs
from linefit.sources import staging, text


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


GOOD = [
    ("2001.0,0.5,0.25,0.1", (2001, 0.5, 0.25, 0.1)),
    ("2001.0,1.5E2,0,0", (2001, 150.0, 0.0, 0.0)),
    (" 2001.0 , 2 ,3,4", (2001, 2.0, 3.0, 4.0)),
    ("1998.9,1,2,3", (1998, 1.0, 2.0, 3.0)),
    ("-1.9,1,2,3", (-1, 1.0, 2.0, 3.0)),
]
BAD = [
    ("2001.0,,3,4", "bad_number"),
    ("2001.0,x,2,3", "bad_number"),
    ("2001.0,1,2,3,", "width"),
    ("1,2", "width"),
    (",".join("1" * 14), "width"),
    ("", "empty"),
    ("   ", "empty"),
    (None, "empty"),
]


@pytest.mark.parametrize("line,expected", GOOD)
def test_good_line(spark, line, expected):
    assert [tuple(r) for r in songs.songs_from_lines(lines(spark, line), 4).collect()] == [expected]


@pytest.mark.parametrize("line,reason", BAD)
def test_bad_line(spark, line, reason):
    table = lines(spark, line)
    assert songs.songs_from_lines(table, 4).count() == 0
    assert [tuple(r) for r in songs.rejected(table, 4).collect()] == [(line, reason)]


def test_nan_is_a_number(spark):
    row = songs.songs_from_lines(lines(spark, "2001.0,NaN,2,3"), 4).first()
    assert row.f1 != row.f1


def test_every_line_is_accepted_or_rejected(spark):
    table = lines(spark, *[g for g, _ in GOOD], *[b for b, _ in BAD])
    assert songs.songs_from_lines(table, 4).count() == len(GOOD)
    assert songs.rejected(table, 4).count() == len(BAD)


def test_without_width_only_the_used_fields_count(spark):
    table = lines(spark, "2001,1,2,3,anything,else", "2001,1,2,3", "2001,1,2", "2001,1,2,3,")
    found = songs.songs_from_lines(table, None).collect()
    assert [tuple(r) for r in found] == [(2001, 1.0, 2.0, 3.0)] * 3
    assert [r.value for r in songs.rejected(table, None).collect()] == ["2001,1,2"]


def test_line_is_split_once(spark):
    """However often later filters and projections mention its fields."""
    df = songs.songs_from_lines(lines(spark, "1,2,3,4"), 4).filter("f1 > 1 and f2 > 1 and f3 > 1")
    assert plan_of(df).count("split(") == 1
    assert "Python" not in plan_of(df)


def test_tokens_close_gaps_and_fields_do_not(spark):
    row = (
        lines(spark, "2001.0,1.5E2,,NaN,3,")
        .select(X.tokens(F.col("value")).alias("t"), X.split_fields(F.col("value")).alias("f"))
        .first()
    )
    assert row.t == ["2001.0", "1.5e2", "nan", "3"]
    assert row.f == ["2001.0", "1.5E2", "", "NaN", "3", ""]


def test_null_line_gives_null_tokens(spark):
    assert lines(spark, None).select(X.tokens(F.col("value"))).first()[0] is None


def test_first_fields_only(spark):
    first = X.split_fields(F.col("value"), ",", 2)
    assert lines(spark, "a,b,c,d").select(first).first()[0] == ["a", "b", "c,d"]


@pytest.mark.parametrize("separator", [",", ";", "|", ".", "||", "^"])
def test_separator_is_literal(spark, separator):
    line = separator.join(["a", "b", "c"])
    parts = lines(spark, line).select(X.split_fields(F.col("value"), separator)).first()[0]
    assert parts == ["a", "b", "c"]


def test_conversions_never_fail(spark):
    df = lines(spark, "", "x", "12.7", "12", "1e400").select(
        X.to_double(F.col("value")).alias("d"), X.to_integer(F.col("value")).alias("i"),
        X.whole(X.to_double(F.col("value"))).alias("w"),
    )
    assert [tuple(r) for r in df.collect()] == [
        (None, None, None), (None, None, None), (12.7, None, 12), (12.0, 12, 12),
        (float("inf"), None, None),
    ]


def test_written_lines_come_back(spark):
    rows = ["a,b", ' "q";x', "tail ", "", "back\\slash"]
    table = lines(spark, *rows)
    plain = text.read_lines(spark, staging.write_lines(table, "t"))
    headed = text.read_lines(spark, staging.write_lines(table.coalesce(1), "t", 'h;"x",y'))
    assert sorted(r.value for r in plain.collect()) == sorted(rows)
    assert [r.value for r in headed.collect()][0] == 'h;"x",y'
    assert sorted(r.value for r in headed.collect()) == sorted([*filter(None, rows), 'h;"x",y'])


def test_staging_needs_a_shared_folder_on_a_cluster(spark):
    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        pass

    session = Session()
    session.conf = Conf(**{"spark.master": "yarn"})
    with pytest.raises(RuntimeError):
        staging.shared_folder(session)
    session.conf = Conf(**{"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared"})
    assert staging.shared_folder(session) == "hdfs:///shared"
