"""Held-out accuracy, the range of scores and what they may depend on."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from layerloom.llm import quality
from layerloom.llm.queries import QUERIES


def test_held_out_accuracy(spark, sf_dir):
    d = sf_dir.replace("0.001", "0.01")
    out = QUERIES["op4_quality"](spark, d)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    rows = out.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [p for q, p in held if q == 1]
    bad = [p for q, p in held if q == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)  # 11 bad ones here


def test_odd_rows(spark, make_docs, odd_pairs):
    docs = make_docs(odd_pairs)
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (2, 1), (7, 0), (8, None), (None, 1), (9, 0), (9, 1), (4, 0), (99, 1)], "doc_id bigint, quality int"
    )
    out = quality.scores(docs, quality.fit(docs, labels)).select(F.col("row.doc_id").alias("i"), "row.score", F.col("score").alias("s"))
    rows = out.collect()
    assert len(rows) == len(odd_pairs) and all(0 <= r["s"] <= 1 for r in rows)
    assert all(r["score"] == "score" for r in rows)  # the input's own column is untouched
    by = {r["i"]: r["s"] for r in rows}
    assert by[1] == by[2] and by[1] > by[7]
    assert by[3] == by[4] == by[5]  # no terms: the share of label 1
    assert quality.scores(docs.limit(0), quality.fit(docs, labels)).count() == 0


def test_nothing_labelled(make_docs, odd_pairs, spark):
    docs = make_docs(odd_pairs)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r["score"] for r in quality.scores(docs, quality.fit(docs, none)).select("score").collect()} == {0.5}


def test_the_sample_is_of_labelled_documents(spark, make_docs, monkeypatch):
    """Labels of absent documents and repeated rows take no place in it."""
    monkeypatch.setattr(quality, "SAMPLE", 30)
    pairs = [(1, "one repeated text")] * 200 + [(i, f"text number {i} here") for i in range(2, 60)]
    labels = [(i, i % 2) for i in range(1, 60)] + [(i, 1) for i in range(1000, 4000)]
    model = quality.fit(make_docs(pairs), spark.createDataFrame(labels, "doc_id bigint, quality int"))
    assert len(model.vectors) == 30 and len(np.unique(np.round(model.vectors, 5), axis=0)) > 20


def test_scores_are_votes_of_the_nearest():
    """Against a search that sorts every cosine."""
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["ab", "cd", "EF", "g1", "h!!", "ij,"], 12, p=p)) for p in rng.dirichlet([0.5] * 6, 120)]
    terms = quality._Terms()
    counts = quality._count(texts, terms)
    sample = [((i := np.flatnonzero(r)).astype(np.int16), r[i]) for r in counts]
    labels = rng.integers(0, 2, 120).astype(float)
    model = quality.Model(sample, labels)
    cosine = (v := model.project(quality.weigh(counts.copy(), model.idf))) @ v.T
    for i, s in enumerate(model.score(counts.copy())):
        near = np.sort(cosine[i])[::-1][: quality.NEIGHBOURS]
        lowest = near[-1]
        sure = cosine[i] > lowest + 1e-5
        assert sure.sum() <= quality.NEIGHBOURS
        weight = np.maximum(cosine[i], 1e-6) ** quality.SHARPNESS
        ties = np.abs(cosine[i] - lowest) <= 1e-5
        room = quality.NEIGHBOURS - sure.sum()
        best = (weight[sure] * labels[sure]).sum() + lowest**4 * min(room, labels[ties].sum())
        worst = (weight[sure] * labels[sure]).sum() + lowest**4 * max(0, room - (ties.sum() - labels[ties].sum()))
        total = weight[sure].sum() + room * lowest**4
        assert worst / total - 1e-4 <= s <= best / total + 1e-4
