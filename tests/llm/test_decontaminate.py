"""Leaks against a longest common subsequence with every stretch of every document."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from layerloom.llm import decontaminate as d
from layerloom.llm.queries import QUERIES


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@given(st.lists(st.integers(0, 4), min_size=1, max_size=70), st.lists(st.integers(-1, 4), max_size=90))
def test_lcs(item, region):
    assert d.lcs(d._masks(item), len(item), np.array(region, np.int32)) == plain_lcs(item, region)


def plain(docs, items):
    """Pairs whose item has ``COVER`` of its words in order in some four blocks of the document."""
    out = set()
    for key, text in docs:
        words = d.words(text or "")
        for item, wanted in items:
            for _, probe, _ in d.Probes.split(item, wanted):
                numbers = {w: i for i, w in enumerate(dict.fromkeys(probe))}
                ids = [numbers[w] for w in probe]
                masks = d._masks(ids)
                for at in range(-d.BLOCK, max(1, len(words)), d.BLOCK):
                    region = np.array([numbers.get(w, -1) for w in words[max(0, at) : max(0, at + 4 * d.BLOCK)]], np.int32)
                    if len(region) and d.lcs(masks, len(ids), region) >= d.COVER * len(ids):
                        out.add((key, item))
                        break
    return out


def prose(rng, n, size=3000):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, size, n))


def test_exact_and_reworded(spark, make_docs, odd_pairs):
    rng = np.random.default_rng(4)
    items = [(i, prose(rng, int(rng.integers(15, 60)))) for i in range(30)] + [(40, prose(rng, 200)), (41, None), (42, "")]
    docs = [(100 + i, prose(rng, 400)) for i in range(60)] + [p for p in odd_pairs if p[0] != 6]
    for i in range(30):
        words = items[i][1].split()
        if i % 3 == 1:  # one word in eight replaced, two swapped
            words = [f"z{j}" if j % 8 == 3 else w for j, w in enumerate(words)]
            words[5], words[6] = words[6], words[5]
        if i % 3 == 2:
            words = [w.upper() + "," for w in words]
        host = prose(rng, 300).split()
        docs.append((200 + i, " ".join(host[: 7 * i] + words + host[7 * i :])))
    docs.append((300, prose(rng, 50) + " " + " ".join(items[30][1].split()[60:140]) + " " + prose(rng, 50)))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    frame = make_docs(docs)
    found = d.contaminated(frame, benchmark, group=8, groups=3)  # two passes
    assert found.columns == ["key", "item", "cover", "cosine", "found_by"]
    want = plain(docs, items)
    assert len(want) >= 31
    assert {(r["key"], r["item"]) for r in found.collect()} == want
    by_group = d.contaminated(frame, benchmark, group=8, groups=1)
    assert {tuple(r)[:3] for r in by_group.collect()} == {tuple(r)[:3] for r in found.collect()}
    kept = d.drop_contaminated(frame, benchmark, group=8, groups=3)
    assert kept.columns == frame.columns
    hit = {k for k, _ in want}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(k) for k, _ in docs if k not in hit)


def test_answer_must_be_there(spark, make_docs):
    rng = np.random.default_rng(6)
    question = prose(rng, 30)
    items = spark.createDataFrame([(1, question + " Answer: forty two")], "item_id bigint, text string")
    docs = make_docs([(1, prose(rng, 60) + " " + question + " answer forty two " + prose(rng, 60)), (2, question), (3, "x")])
    assert [r["key"] for r in d.contaminated(docs, items).collect()] == [1]


def test_paraphrase_with_the_answer(spark, make_docs):
    """Half of the words in order, out of the plain threshold, and the whole answer: only the latent space proposes it."""
    rng = np.random.default_rng(12)
    question = [f"q{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(question) + " Answer: forty two")], "item_id bigint, text string")
    half = [w if i % 2 else f"other{i}" for i, w in enumerate(question)]
    host = prose(rng, 40)
    docs = make_docs([
        (1, f"{host} {' '.join(half)} answer forty two {host}"),
        (2, f"{host} {' '.join(half)} answer forty one {host}"),
        (3, f"{host} {' '.join(half[:12])} answer forty two {host}"),
        (4, f"{host} {' '.join(question)} answer forty two"),
    ] + [(10 + i, prose(rng, 120)) for i in range(40)])
    found = {r["key"]: r["found_by"] for r in d.contaminated(docs, items).collect()}
    assert found == {1: "latent", 4: "both"}


def test_texts_are_read_for_many_groups_at_once(spark, make_docs, monkeypatch):
    rng = np.random.default_rng(2)
    items = [(i, prose(rng, 30)) for i in range(12)]
    passes = []
    located = d._block_terms
    monkeypatch.setattr(d, "_block_terms", lambda rows, words: passes.append(len(words.value)) or located(rows, words))
    docs = make_docs([(i, prose(rng, 50) + " " + text) for i, text in items])
    found = d.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string"), group=3, groups=4)
    assert len(passes) == 1 and passes[0] == len({w for _, t in items for w in t.split()})
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert {(r["key"], r["item"]) for r in found.collect()} == {(i, i) for i, _ in items}


def test_latent_space_proposes_most_leaks(spark, sf_dir):
    found = QUERIES["op8_decontamination"](spark, sf_dir.replace("0.001", "0.01")).groupBy("found_by").count().collect()
    counts = {r["found_by"]: r["count"] for r in found}
    assert counts.get("words", 0) <= 0.1 * sum(counts.values())


def zipf(rng, n):
    return [f"w{int(x)}" for x in rng.zipf(1.2, 3 * n) if x < 20_000][:n]


@pytest.mark.parametrize("size", [50, 1500])
def test_items_of_frequent_words(spark, make_docs, size):
    rng = np.random.default_rng(7)
    docs = [(i, " ".join(zipf(rng, 300))) for i in range(size)]
    frequent = [w for w, _ in Counter(w for _, t in docs for w in t.split()).most_common(400)]
    items = [(i, " ".join(rng.choice(frequent[: (50, 100, 200, 400)[i % 4]], 24))) for i in range(16)]
    items += [(100 + i, " ".join(zipf(rng, 30))) for i in range(10)]
    for i, item in items:
        host = [f"o{int(x)}" for x in rng.integers(0, 9999, 200)] if i % 2 else zipf(rng, 200)
        docs.append((10_000 + i, " ".join(host[:90]) + " " + item + " " + " ".join(host[90:])))
    want = plain(docs, items)
    assert {(10_000 + i, i) for i, _ in items} <= want
    found = d.contaminated(make_docs(docs), spark.createDataFrame(items, "item_id bigint, text string"))
    assert {(r["key"], r["item"]) for r in found.collect()} == want


def test_reworded_given_items(spark, sf_dir):
    """The rarest 30 % of the words of each given item replaced, and a random 30 %."""
    rng = np.random.default_rng(9)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    texts = [r["text"] or "" for r in docs.collect()]
    seen = Counter(w for t in texts for w in set(d.words(t)))
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    planted = []
    for n, (_, text) in enumerate(items):
        found = [w.decode() for w in d.words(text)]
        rare = sorted(range(len(found)), key=lambda i: seen[found[i].encode()])
        host = texts[int(rng.integers(0, len(texts)))].split()[:80]
        for kind, at in enumerate((rare, rng.permutation(len(found)).tolist())):
            at = set(at[: int(0.3 * len(found))])
            words = [f"zz{i}" if i in at else w for i, w in enumerate(found)]
            planted.append((-1 - 2 * n - kind, " ".join([*host, *words, *host])))
    want = plain(planted, items)
    assert len(want) > len(items)
    every = docs.unionByName(spark.createDataFrame(planted, "doc_id bigint, text string"))
    out = d.contaminated(every, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("key < 0").collect()
    assert {(r["key"], r["item"]) for r in out} == want


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "one two three four")], "item_id bigint, text string")
    docs = make_docs([(1, "one two three four five")])
    assert d.contaminated(docs, none).count() == 0 and d.drop_contaminated(docs, none).count() == 1
    assert d.contaminated(docs.limit(0), some).count() == 0 and d.drop_contaminated(docs.limit(0), some).count() == 0
    assert d.drop_contaminated(docs, some).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    want = plain([tuple(r) for r in docs], [tuple(r) for r in items])
    out = QUERIES["op8_decontamination"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == want
