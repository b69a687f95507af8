"""The shapes the programs work on, as views over the given parquet tables.

Nothing here samples or caps: every view has a row for each row of its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.functions.vectors import width_metadata
from linefit.plans import fixed_values as K

LINE_KEYS = ["l_orderkey", "l_linenumber"]
BANK_HEADER = '"age";"job";"marital";"education";"default";"balance"'
CSV_HEADER = ",".join(K.CSV_COLUMNS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def plain(c: Column) -> Column:
    """Without negative zeros."""
    return c + F.lit(0.0)


def _song_columns() -> dict[str, Column]:
    return {
        "year": F.year("l_shipdate").cast("int"),
        "f1": F.col("l_quantity") / 50,
        "f2": plain(F.col("l_discount")),
        "f3": plain(F.col("l_tax")),
    }


def songs(spark: SparkSession, folder: str, keep=()) -> DataFrame:
    """Line items as ``year, f1, f2, f3``."""
    columns = [c.alias(n) for n, c in _song_columns().items()]
    return table(spark, folder, "lineitem").select(*keep, *columns)


def song_lines(spark: SparkSession, folder: str, keep=()) -> DataFrame:
    """Line items as comma-separated lines of 13 numbers, in ``value``."""
    first = _song_columns()
    first["year"] = first["year"].cast("double")
    others = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    others += ["l_extendedprice", "l_discount", "l_tax"]
    columns = [*first.values(), *map(F.col, others), F.lit(0)]
    line = F.concat_ws(",", *[c.cast("string") for c in columns])
    return table(spark, folder, "lineitem").select(*keep, line.alias("value"))


def damaged_song_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines, some of them too long, too short, blank or with a word for a number."""
    kind, line = F.col("l_linenumber"), F.col("value")
    damaged = (
        F.when(kind == 7, F.substring_index(line, ",", 3))
        .when(kind == 6, F.concat(line, F.lit(",")))
        .when(kind == 5, F.lit(" "))
        .when(kind == 4, F.concat_ws(",", F.lit("2000.0,x"), F.substring_index(line, ",", -11)))
        .otherwise(line)
    )
    return song_lines(spark, folder, ["l_linenumber"]).select(damaged.alias("value"))


def non_finite_song_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines, some of them with NaN or an infinite number."""
    kind, line = F.col("l_linenumber"), F.col("value")
    rest = F.substring_index(line, ",", -12)
    odd = (
        F.when(kind == 1, F.concat(F.lit("NaN,"), rest))
        .when(kind == 2, F.concat(F.lit("Infinity,"), rest))
        .when(kind == 3, F.concat_ws(",", F.lit("2001.0,-Infinity"), F.substring_index(line, ",", -11)))
        .otherwise(line)
    )
    return song_lines(spark, folder, ["l_linenumber"]).select(odd.alias("value"))


def _features(*columns: Column) -> Column:
    return F.array(*columns).alias("features", metadata=width_metadata(len(columns)))


def price_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``label`` = price, ``features`` = (quantity, discount, tax), all of order one."""
    c = _song_columns()
    return table(spark, folder, "lineitem").select(
        *LINE_KEYS,
        (F.col("l_extendedprice") / 100000).alias("label"),
        _features(c["f1"], c["f2"], c["f3"]),
    )


def charge_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``label`` = price after discount and tax, ``features`` = (price, discount, tax)."""
    price = F.col("l_extendedprice") / 100000
    charge = price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return table(spark, folder, "lineitem").select(
        *LINE_KEYS,
        charge.alias("label"),
        _features(price, plain(F.col("l_discount")), plain(F.col("l_tax"))),
    )


def near_perfect_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``label`` = 2 · price + 1, and 1e-9 more or less for even or odd orders."""
    price = F.col("l_extendedprice") / 100000
    term = F.when(F.col("l_orderkey") % 2 == 0, 1e-9).otherwise(-1e-9)
    return table(spark, folder, "lineitem").select((2 * price + 1 + term).alias("label"), _features(price))


def perfect_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``label`` is half the only feature, which is the price in a unit that lets descent get near."""
    feature = F.col("l_extendedprice") / 60000
    return table(spark, folder, "lineitem").select(*LINE_KEYS, (feature / 2).alias("label"), _features(feature))


def damaged_embedding_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The embeddings; every third has a NaN, a null or one element too few."""
    v, kind = F.col("features"), F.col("vec_id") % 9
    damaged = (
        F.when(kind == 0, F.transform(v, lambda x, i: F.when(i == 5, float("nan")).otherwise(x)))
        .when(kind == 3, F.transform(v, lambda x, i: F.when(i != 5, x)))
        .when(kind == 6, F.slice(v, 1, F.size(v) - 1))
        .otherwise(v)
    )
    return embedding_rows(spark, folder).withColumn("features", damaged)


def embedding_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``label`` = class number / 10, ``features`` = the embedding."""
    return table(spark, folder, "embeddings").select(
        "vec_id",
        (F.col("label") / 10).alias("label"),
        F.col("embedding").cast("array<double>").alias("features"),
    )


def bank_lines(
    spark: SparkSession, folder: str, delimiter_in_job: bool = False, keep=(), between: str = ";",
) -> DataFrame:
    """Parts as quoted lines between semicolons; the job may hold the text ``between``."""
    job = F.concat_ws(between, "p_type", "p_brand") if delimiter_in_job else F.col("p_type")

    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    line = F.concat_ws(
        ";", F.col("p_size").cast("string"), quoted(job), quoted(F.col("p_brand")),
        quoted(F.col("p_name")), quoted(F.lit("no")),
        F.col("p_retailprice").cast("int").cast("string"),
    )
    return table(spark, folder, "part").select(*keep, line.alias("value"))


def damaged_bank_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same lines; small parts lack a field, and some sizes or prices are words."""
    size, line = F.col("p_size"), F.col("value")
    damaged = (
        F.when(size <= 10, F.substring_index(line, ";", 5))
        .when(size <= 15, F.concat(F.lit("old;"), F.substring_index(line, ";", -5)))
        .when(size <= 20, F.concat(F.substring_index(line, ";", 5), F.lit(";12.5")))
        .otherwise(line)
    )
    return bank_lines(spark, folder, keep=["p_size"]).select(damaged.alias("value"))


def bank(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_size").alias("age"),
        F.col("p_type").alias("job"),
        F.col("p_brand").alias("marital"),
        F.col("p_name").alias("education"),
        F.col("p_retailprice").cast("int").alias("balance"),
    )


def wide_records(spark: SparkSession, folder: str, keep=()) -> DataFrame:
    """Orders as 18 text columns. The year is blank, zero, fractional or whole, depending on
    status and priority of the order."""
    year = F.year("o_orderdate").cast("string")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    numbers = {
        "Year": F.when(priority == "2-HIGH", "0")
        .when(status == "P", "")
        .when(status == "F", F.concat(year, F.lit(".5")))
        .otherwise(year),
        "Duration": F.col("o_totalprice") / 500000,
        "KeySignature": F.col("o_orderkey") % 12,
        "KeySignatureConfidence": (F.col("o_custkey") % 100) / 100,
        "Tempo": F.month("o_orderdate"),
        "TimeSignature": F.dayofmonth("o_orderdate") % 7,
        "TimeSignatureConfidence": (F.col("o_orderkey") % 97) / 97,
        "SongNumber": F.col("o_orderkey"),
    }
    columns = [
        numbers.get(n, priority if n.startswith("Artist") else status).cast("string").alias(n)
        for n in K.CSV_COLUMNS
    ]
    return table(spark, folder, "orders").select(*keep, *columns)


def wide_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The wide records as lines; urgent orders lack a field, those of low priority have one
    too many."""
    line = F.concat_ws(",", *K.CSV_COLUMNS)
    priority = F.col("o_orderpriority")
    damaged = (
        F.when(priority == "1-URGENT", F.substring_index(line, ",", 17))
        .when(priority == "5-LOW", F.concat(line, F.lit(",x")))
        .otherwise(line)
    )
    records = wide_records(spark, folder, ["o_orderpriority"])
    return records.select(damaged.alias("value"))


def odd_wide_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The wide lines with a word or an infinite number as the tempo of some orders."""
    priority = F.col("o_orderpriority")
    tempo = F.col("o_custkey") % 10
    records = wide_records(spark, folder, ["o_orderpriority", "o_custkey"]).withColumn(
        "Tempo", F.when(tempo == 0, "fast").when(tempo == 1, "Infinity").otherwise(F.col("Tempo"))
    )
    line = F.concat_ws(",", *K.CSV_COLUMNS)
    damaged = (
        F.when(priority == "1-URGENT", F.substring_index(line, ",", 17))
        .when(priority == "5-LOW", F.concat(line, F.lit(",x")))
        .otherwise(line)
    )
    return records.select(damaged.alias("value"))
