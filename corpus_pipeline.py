"""The pipeline over documents: language, near-duplicates, personal data, packing.

Every stage works on all rows that the one before it has kept, and is written as Parquet in
the shared folder before the next one reads it, and removed once the next one is written. All
stages but the last return the columns of ``documents``, and further ones that it may have, whatever
their names. Null texts have no language and go at the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from linefit.llm import byte_cnn, packing, pii, queries, simhash
from linefit.llm.common import discard, row_of, small_batches, staged, unpacked

#: A document goes if its best language has less than this share of it.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those that are ``und`` or of no clear language go.

    The network learns from the labelled rows of ``docs`` that op5 may learn from. If there are
    none, only documents without a letter go.
    """
    small_batches(spark)
    network = byte_cnn.learn(docs, F.col("doc_id").isNotNull() & ~queries.held_out())
    if network is None:
        return docs.where(F.col("text").rlike("\\p{L}"))
    found = byte_cnn.scored(docs, network)
    clear = (F.col("language") != byte_cnn.UNKNOWN) & (F.col("share") >= LEAST_SCORE)
    return found.where(clear).select(*unpacked(found, docs.columns, {"text": F.col("text")}))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one whose id names the component.

    Of rows that repeat an id one stays. Rows with a null id cannot be named and all stay.
    """
    small_batches(spark)
    groups = simhash.near_duplicates(docs.select("doc_id", "text"))
    named = groups.where("doc_id = component_id").select("doc_id").distinct()
    nth = F.row_number().over(W.partitionBy("doc_id").orderBy("doc_id"))
    rows = docs.select("doc_id", row_of(docs))
    kept = rows.join(named.hint("merge"), "doc_id", "left_semi").withColumn("nth", nth).where("nth = 1")
    kept = kept.unionByName(rows.where("doc_id is null").withColumn("nth", F.lit(1)))
    return kept.select(*unpacked(kept, docs.columns))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replaced(docs, secret=queries.SECRET)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", replace_personal_data),
    ("packing", pack),
]

#: No stage can be expressed in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        docs, path = staged(stage(spark, docs, sf_dir), "stage")
        if before:
            discard(spark, before)
        before = path
    return docs
