"""The registered query of every operator here, over whole tables, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm import (
    alignment,
    decontaminate,
    license_scan,
    mixing,
    packing,
    pii,
    prefix_trie,
    quality,
    repeats,
    sharding,
    simhash,
    token_counts,
    topk,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence notice in ``documents``."""
    return license_scan.licence_scan(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and tokens of every document."""
    return token_counts.token_counts(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def held_out(doc_id: str) -> Column:
    """The fifth of documents whose labels nothing learns from; a NULL id is not in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def learnable(labels: DataFrame) -> DataFrame:
    return labels.where(~held_out("doc_id"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned from labels outside the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.scores(docs.select("doc_id", "text"), quality.fit(docs, learnable(labels)))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out("row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digest(pii.personal_data(table(spark, sf_dir, "documents")))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated strings of 200 bytes."""
    return repeats.without_repeats(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item."""
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnsRenamed({"key": "doc_id", "item": "item_id"})


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, none over 16 MiB."""
    placed = sharding.extendible_shards(table(spark, sf_dir, "documents"))
    return placed.select(F.col("row.doc_id").alias("doc_id"), F.col("size").alias("n_bytes"), "shard_depth", "shard")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document in the mix, in its order."""
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.poisson_mix(docs, mixing.repetition_rates(docs))
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "copy", "shuffle_key"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct beginning of ``conversations``, each begun as the first of its hundred ids is."""
    turns = prefix_trie.numbered_turns(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns), slack=prefix_trie.BORROWED)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of ``documents``."""
    return packing.pack(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links between two tokenizers' tokens of every document, with their counts over all documents."""
    return alignment.align(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_license_scan,
        op2_topk,
        op3_token_counts,
        op4_quality,
        op5_simhash,
        op6_pii,
        op7_repeats,
        op8_decontamination,
        op9_sharding,
        op10_mixing,
        op11_prefix_trie,
        op12_packing,
        op13_alignment,
    )
}
