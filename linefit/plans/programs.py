"""The eight programs over files: each returns named tables for the caller to show or write."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from linefit.operators import stages as S
from linefit.plans import bank, regression, songs
from linefit.plans import fixed_values as K
from linefit.sources import delimited, multiline, splits, text
from linefit.sources.memory import from_rows
from linefit.sources.staging import write_table

Tables = dict[str, DataFrame]
Keys = Sequence[str] | None
Program = Callable[..., Tables]
PREVIEW = 10
SCORED = ["prediction", "label", "features"]
BY_LINE = ("value",)


class _Lines:
    """The good lines of a file, and the number of rejected ones by reason.

    The rejects are counted on the way by the first full pass over the lines, whatever it is.
    Without ``keys`` a line's key is its address, its file and the byte at which it starts.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Keys = BY_LINE):
        self.spark, self.seen = spark, Observation()
        self.keys = [splits.FILE, splits.OFFSET] if keys is None else list(keys)
        lines = splits.addressed_lines(spark, path) if keys is None else text.read_lines(spark, path)
        checked = text.with_reason(lines, songs.NUMERIC, K.LINE_WIDTH, finite=True)
        reason = F.col(text.REASON)
        counts = [F.count_if(reason == r).alias(r) for r in text.REASONS]
        watched = checked.observe(self.seen, *counts)
        self.lines = watched.filter(reason.isNull()).drop(text.REASON)

    def rows(self) -> DataFrame:
        return regression.prepared(self.lines, regression.number_stages("numbers"))

    def rejected(self) -> DataFrame:
        counts = [(r, n) for r, n in self.seen.get.items() if n]
        return from_rows(self.spark, counts, "reason string, count long")


def _preview(scored: DataFrame, *columns: str) -> DataFrame:
    return scored.select(*columns).orderBy(*columns).limit(PREVIEW)


def song_summary(spark: SparkSession, path: str) -> Tables:
    """The lines are read once, for a small table that answers every question."""
    counts = songs.counted_lines(text.read_lines(spark, path))
    return songs.questions_from_counts(write_table(counts, "songs-per-year"))


def song_features(spark: SparkSession, path: str) -> Tables:
    source = _Lines(spark, path)
    shift = regression.number_stages("numbers", shift=S.MinimumLabelShift())
    rows = Pipeline(stages=shift).fit(source.lines).transform(source.lines)
    return {"rows": _preview(rows, "features", "label"), "rejected": source.rejected()}


def elastic_net(spark: SparkSession, path: str, keys: Keys = BY_LINE) -> Tables:
    source = _Lines(spark, path, keys)
    rows = source.rows()
    model, errors = regression.elastic_net(rows, source.keys)
    test = regression.test_rows(rows, K.SPLIT_7_3, source.keys, 0)
    return {
        "errors": errors, "scored": _preview(model.transform(test), *SCORED),
        "rejected": source.rejected(),
    }


def _tuned(source: _Lines, rows: DataFrame, search) -> Tables:
    model, errors = search(rows, source.keys)
    test = regression.test_rows(rows, K.SPLIT_9_1, source.keys, K.TUNING_SEED)
    scored = model.transform(test).select(
        "prediction", "label", F.col(model.getFeaturesCol()).alias("features")
    )
    return {
        "grid": model.mean_table(source.spark), "best": model.best_table(source.spark),
        "errors": errors, "scored": _preview(scored, *SCORED), "rejected": source.rejected(),
    }


def ridge_search(spark: SparkSession, path: str, keys: Keys = BY_LINE) -> Tables:
    source = _Lines(spark, path, keys)
    return _tuned(source, source.rows(), regression.tuned_ridge)


def degree_two_search(spark: SparkSession, path: str, keys: Keys = BY_LINE) -> Tables:
    source = _Lines(spark, path, keys)

    def search(rows, keys):
        return regression.tuned_ridge(rows, keys, features="products")

    return _tuned(source, regression.with_products(source.rows()), search)


def descent(spark: SparkSession, path: str, keys: Keys = BY_LINE) -> Tables:
    source = _Lines(spark, path, keys)
    rows = source.rows()
    model, errors = regression.gradient_descent(rows, source.keys)
    test = regression.test_rows(rows, K.SPLIT_9_1, source.keys, 0)
    return {
        "history": model.history_table(spark), "weights": model.weights_table(spark),
        "errors": errors, "scored": _preview(model.transform(test), *SCORED),
        "rejected": source.rejected(),
    }


def wide_csv(spark: SparkSession, path: str) -> Tables:
    records = delimited.read_delimited(spark, path).select(*K.CSV_COLUMNS)
    model, errors = regression.wide_csv_regression(records)
    checked = delimited.checked_records(spark, path)
    return {
        "errors": errors, "weights": model.weights_table(spark),
        "rejected": regression.wide_csv_rejects(checked),
    }


def bank_ages(spark: SparkSession, path: str, reader=delimited) -> Tables:
    """``reader`` is :mod:`multiline` for files whose quoted fields hold line breaks."""
    return {
        "ages": bank.customers_per_age(bank.read_bank(spark, path, reader)),
        "rejected": bank.rejected_records(spark, path, reader),
    }


PROGRAMS: dict[str, Program] = {
    "song-summary": song_summary,
    "song-features": song_features,
    "elastic-net": elastic_net,
    "ridge-search": ridge_search,
    "degree-two-search": degree_two_search,
    "descent": descent,
    "wide-csv": wide_csv,
    "bank-ages": bank_ages,
}
#: Programs over delimited records, which :mod:`multiline` can read.
RECORDS = {"bank-ages": multiline}
#: Programs that split the rows and take ``keys``: None draws every row by itself.
SPLITTING = ("elastic-net", "ridge-search", "degree-two-search", "descent")
