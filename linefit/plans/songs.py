"""Song lines: typed rows and the four summary questions, by DataFrame and by SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.functions import fields as X
from linefit.operators import summary
from linefit.plans import fixed_values as K
from linefit.sources import text
from linefit.sources.memory import unique_view

NUMERIC = [K.LABEL_FIELD, *K.FEATURE_FIELDS]


def good_lines(
    lines: DataFrame, width: int | None = K.LINE_WIDTH, finite: bool = False
) -> DataFrame:
    """Lines that hold a song, with its year and features in ``numbers``."""
    return text.good_lines(lines, NUMERIC, width, finite=finite)


def _year() -> Column:
    return X.whole(F.get("numbers", F.lit(0)))


def songs_from_lines(
    lines: DataFrame, width: int | None = K.LINE_WIDTH, keep: Sequence[str] = ()
) -> DataFrame:
    """``year int, f1, f2, f3 double`` from the good lines."""
    numbers = F.col("numbers")
    return good_lines(lines, width).select(
        *keep,
        _year().alias("year"),
        *[F.get(numbers, F.lit(k)).alias(f"f{k}") for k in range(1, len(NUMERIC))],
    )


def rejected(
    lines: DataFrame, width: int | None = K.LINE_WIDTH, finite: bool = False
) -> DataFrame:
    return text.rejected_lines(lines, NUMERIC, width, finite=finite)


def questions(songs: DataFrame) -> dict[str, DataFrame]:
    """How many songs; how many in 1998–2000; range and mean of the year; songs per year."""
    return {
        "song_count": summary.row_count(songs),
        "song_count_1998_2000": summary.row_count_between(songs, "year", *K.YEARS_COUNTED),
        "year_min_max_avg": summary.min_max_avg(songs, "year"),
        "songs_per_year": summary.count_per_key(
            songs, "year", F.col("year").between(*K.YEARS_LISTED)
        ),
    }


def counted_lines(lines: DataFrame, width: int | None = K.LINE_WIDTH) -> DataFrame:
    """``(reason, year, count)``: all the questions ask, and the rejects, from one scan."""
    checked = text.with_reason(lines, NUMERIC, width)
    year = F.when(F.col(text.REASON).isNull(), _year())
    return checked.groupBy(text.REASON, year.alias("year")).agg(F.count("*").alias("count"))


def questions_from_counts(counts: DataFrame) -> dict[str, DataFrame]:
    """The answers of :func:`questions` and the rejects, from a table of counts."""
    songs = counts.filter(F.col(text.REASON).isNull())
    rows, year = F.sum("count"), F.col("year")
    total = F.coalesce(rows, F.lit(0)).alias("count")
    dated = songs.filter(year.isNotNull())
    return {
        "song_count": songs.agg(total),
        "song_count_1998_2000": dated.filter(year.between(*K.YEARS_COUNTED)).agg(total),
        "year_min_max_avg": dated.agg(
            F.min("year").alias("min"), F.max("year").alias("max"),
            (F.sum(year.cast("double") * F.col("count")) / rows).alias("avg"),
        ),
        "songs_per_year": dated.filter(year.between(*K.YEARS_LISTED)).select("year", "count"),
        "rejected_lines": counts.filter(F.col(text.REASON).isNotNull()).select(
            text.REASON, "count"
        ),
    }


def question_sql(view: str = "songs") -> dict[str, str]:
    """The same questions as SQL text over a registered view."""
    (a, b), (c, d) = K.YEARS_COUNTED, K.YEARS_LISTED
    count = "SELECT count(*) AS count"
    return {
        "song_count": f"{count} FROM {view}",
        "song_count_1998_2000": f"{count} FROM {view} WHERE year BETWEEN {a} AND {b}",
        "year_min_max_avg": (
            f"SELECT min(year) AS min, max(year) AS max, avg(year) AS avg FROM {view}"
        ),
        "songs_per_year": (
            "SELECT year, count(*) AS count "
            f"FROM {view} WHERE year BETWEEN {c} AND {d} GROUP BY year"
        ),
    }


def questions_by_sql(spark: SparkSession, songs: DataFrame):
    view = unique_view(songs, "songs")
    return {name: spark.sql(query) for name, query in question_sql(view).items()}
