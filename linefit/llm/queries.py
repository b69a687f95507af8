"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefit.llm import (
    bpe_tree, byte_cnn, chat, huffman, packing, pii, prefix_forest, prefix_trie, product_quantiser,
    secret_scan, simhash, spelling, warc,
)
from linefit.llm.common import table
from linefit.llm.twins import TWINS  # noqa: F401  the SQL of those that SQL can express

#: Example of a secret; a real one comes from the caller.
SECRET = "an example, not a secret"


def op1_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pii.replaced(docs, secret=SECRET, count_as="n_entities").select("doc_id", "text", "n_entities")


def op2_prefix_forest(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_forest.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_product_quantiser(spark: SparkSession, folder: str) -> DataFrame:
    return product_quantiser.near_duplicates(table(spark, folder, "embeddings"))


def op4_bpe_tree(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bpe_tree.encode(table(spark, folder, "documents"))
    return bpe_tree.decode(encoded).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )


def held_out(key: str = "doc_id"):
    """Rows that language identification must not learn from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op5_byte_cnn(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    network = byte_cnn.learn(docs, F.col("doc_id").isNotNull() & ~held_out())
    return byte_cnn.predict(docs, network, carry=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), F.col("_language").alias("lang_pred"),
        F.col("_share").alias("score"),
    )


def op6_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op7_huffman(spark: SparkSession, folder: str) -> DataFrame:
    archive = huffman.write(table(spark, folder, "documents"))
    return huffman.read(spark, archive, with_ids=False).withColumnRenamed("key", "doc_id")


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op9_chat(spark: SparkSession, folder: str) -> DataFrame:
    chats = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    return chat.digests(chat.formatted(chats.unionByName(own))).withColumnRenamed("conv", "conv_id")


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.write(table(spark, folder, "pages"))
    return warc.read(index).drop("url")


def op11_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op12_secret_crf(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    field = secret_scan.learn(docs, source="source")
    return secret_scan.digests(secret_scan.scan(docs, field, source="source"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """Conversations that begin with the first turns of another: of c − c % 5 (the sign of c kept)
    as many as a hash of c says, then c's own turns after that many."""
    conv = F.col("conv")
    borrowed = F.crc32(conv.cast("string").cast("binary")) % 9
    own = turns.where((F.col("kind") == prefix_trie.MARK) | (F.col("nth") >= borrowed)).withColumn("kind", F.col("kind") * 2)
    lent = (
        turns.where((F.col("kind") == prefix_trie.TURN) & (conv % 5 == 0) & (F.col("nth") < 8))
        .withColumn("from", conv).withColumn("conv", F.explode(F.sequence(conv - 4, conv + 4)))
        .where((conv - conv % 5 == F.col("from")) & (F.col("nth") < borrowed)).drop("from")
    )
    return own.unionByName(lent)


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns, _ = prefix_trie.turns(table(spark, folder, "conversations"))
    return prefix_trie.trie(rebuilt(turns))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pii_surrogates, op2_prefix_forest, op3_product_quantiser, op4_bpe_tree, op5_byte_cnn,
        op6_bin_slack, op7_huffman, op8_simhash, op9_chat, op10_warc, op11_spelling,
        op12_secret_crf, op13_prefix_trie, pipeline,
    )
}
