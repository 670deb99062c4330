"""Stages one by one and the whole run."""

from pyspark.sql import functions as F

import corpus_pipeline
from layerloom.llm import decontaminate, quality, simhash
from layerloom.llm.queries import learnable


def test_run_follows_the_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    model = quality.fit(docs, learnable(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    good = {r[0] for r in quality.scores(docs, model).where("score >= 0.3").select("row.doc_id").collect()}
    stage = dict(corpus_pipeline.STAGES)
    first = stage["quality"](spark, docs, sf_dir)
    assert first.columns == docs.columns and {r["doc_id"] for r in first.collect()} == good

    kept = docs.where(F.col("doc_id").isin(*good))
    groups = {r["component_id"] for r in simhash.near_duplicates(kept).collect()}
    second = stage["near_duplicates"](spark, kept, sf_dir)
    assert second.columns == docs.columns and {r["doc_id"] for r in second.collect()} == groups

    kept = docs.where(F.col("doc_id").isin(*groups))
    leaks = {r["key"] for r in decontaminate.contaminated(kept, items).collect()}
    third = stage["decontamination"](spark, kept, sf_dir)
    assert third.columns == docs.columns and {r["doc_id"] for r in third.collect()} == groups - leaks

    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == [*docs.columns, "shard"]
    rows = out.collect()
    assert {r["doc_id"] for r in rows} <= groups - leaks
    assert len(rows) > 0.5 * len(groups)


def test_stages_are_named_once():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(set(names)) == len(names) == 5


def test_odd_rows_pass_every_stage(spark, make_docs, odd_pairs, sf_dir):
    docs = make_docs(odd_pairs)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert [c for c in out.columns if c != "shard"] == [c for c in docs.columns if c != "shard"]
        out.count()
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
