"""Training corpus from documents: each stage's rows are stored and read again by the next."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.llm import decontaminate, mixing, quality, sharding, simhash
from layerloom.llm.common import delete, shared_dir
from layerloom.llm.queries import learnable, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their labelled neighbours vote for."""
    model = quality.fit(docs, learnable(table(spark, sf_dir, "labels")))
    kept = quality.scores(docs, model).where(F.col("score") >= quality.THRESHOLD)
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link, by the operator's shingles and radius."""
    return simhash.drop_near_duplicates(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated or thinned to their target weights, in one global random order."""
    return mixing.mix_sources(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard each belongs to."""
    return sharding.with_shards(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", clean),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The first three stages have no SQL form; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the table before the last stage stays for whoever evaluates the result."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:  # nothing reads it any more
            delete(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
