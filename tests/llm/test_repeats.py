"""Repeated strings against a count of every string."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from layerloom.llm import repeats
from layerloom.llm.queries import QUERIES


def plain(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + 200] for d in data for i in range(len(d) - 199))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 199):
            if seen[d[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        runs = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(gone) else 0))
        out.append((len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def result(docs, **options):
    rows = repeats.without_repeats(docs, **options).collect()
    return sorted((str(r["key"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)


def expected(pairs):
    return sorted((str(k), *v) for (k, _), v in zip(pairs, plain([t for _, t in pairs])))


def noise(rng, n, alphabet="abcdefghij "):
    return "".join(rng.choice(list(alphabet), n))


@pytest.mark.parametrize("bucket", [repeats.BUCKET, 2])
def test_planted_passages(make_docs, bucket):
    rng = np.random.default_rng(1)
    passage, other = noise(rng, 700), noise(rng, 260)
    pairs = [(i, noise(rng, 300 + 40 * i)) for i in range(8)]
    pairs += [(10 + i, noise(rng, 150) + passage[i * 40 : i * 40 + 350] + noise(rng, 120)) for i in range(7)]
    pairs += [(30, other), (31, "x" + other), (32, other + "y"), (33, other[:199]), (34, other[30:230])]
    pairs += [(40, "ab" * 400), (41, "é" * 300), (42, noise(rng, 250) + "ü" * 110 + noise(rng, 90))]
    pairs += [(50, noise(rng, 90) + "é" * 101), (51, passage[:200] + noise(rng, 10) + passage[:200])]
    assert result(make_docs(pairs), bucket=bucket) == expected(pairs)


@pytest.mark.parametrize("bucket", [repeats.BUCKET, 1])
def test_odd_rows(make_docs, odd_pairs, bucket):
    pairs = [(k, t[:5000] if t else t) for k, t in odd_pairs] + [(70, "a" * 199), (71, "b" * 200), (72, "b" * 201)]
    assert result(make_docs(pairs), bucket=bucket) == expected(pairs)


def test_texts_over_a_chunk(make_docs, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 700)
    rng = np.random.default_rng(2)
    long = noise(rng, 5000)
    texts = [long, noise(rng, 900) + long[1000:1800], long[:230], "q" * 1500]
    for text in texts:
        data = text.encode()
        windows = {i: min(range(i, i + 137), key=lambda p: (repeats.gram_hashes(np.frombuffer(data, np.uint8))[p] >> np.uint64(24), p)) for i in (0, 10)} if len(data) < 1200 and len(data) >= 220 else {}
        found = {int(p) for _, place, _ in repeats.anchors([data]) for p in place}
        assert set(windows.values()) <= found
    pairs = list(enumerate(texts))
    assert result(make_docs(pairs)) == expected(pairs)


@pytest.mark.parametrize("bucket", [repeats.BUCKET, 40, 6])
def test_a_passage_with_very_many_surroundings(make_docs, bucket):
    """Buckets of one passage's edges, larger than a task's and of several lengths, also within one text."""
    rng = np.random.default_rng(8)
    passage = noise(rng, 420)
    pairs = []
    for i in range(150):
        low, high = (0, 420) if i % 3 else (int(rng.integers(0, 150)), int(rng.integers(260, 420)))
        pairs.append((i, noise(rng, int(rng.integers(0, 90))) + passage[low:high] + noise(rng, int(rng.integers(0, 90)))))
    pairs.append((900, "".join(noise(rng, 20) + passage[j * 7 : j * 7 + 230] for j in range(20))))
    assert result(make_docs(pairs), bucket=bucket) == expected(pairs)


def test_nothing_is_left_behind(spark, make_docs):
    from pathlib import Path

    from layerloom.llm.common import shared_dir

    rng = np.random.default_rng(9)
    passage = noise(rng, 300)
    docs = make_docs([(i, noise(rng, 100) + passage + noise(rng, 100)) for i in range(30)])
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = {p.name for p in folder.iterdir()}
    repeats.without_repeats(docs, bucket=4).collect()
    left = {p.name for p in folder.iterdir()} - before
    assert not {n for n in left if n.startswith(("anchors", "contexts", "cores", "halves", "grams"))}


def test_unique_text_over_two_chunks_stays_whole(make_docs):
    rng = np.random.default_rng(3)
    long = noise(rng, (2 << 20) + 5000)
    assert result(make_docs([(1, long)])) == [("1", len(long), 0, 0, hashlib.sha256(long.encode()).hexdigest())]


def test_chunk_reaches_the_tasks(make_docs):
    rng = np.random.default_rng(4)
    long = noise(rng, 9000)
    pairs = [(1, long), (2, noise(rng, 500) + long[4000:4900] + noise(rng, 2000)), (3, noise(rng, 6000))]
    for bucket in (repeats.BUCKET, 1):
        assert result(make_docs(pairs), chunk=700, bucket=bucket) == expected(pairs)


def test_equal_rows_give_their_spans_once(make_docs):
    rng = np.random.default_rng(6)
    text = noise(rng, 900)
    pairs = [(1, text)] * 300 + [(2, noise(rng, 400))]
    spans = repeats.repeated_spans(make_docs(pairs))
    once = spans.distinct().count()
    assert spans.count() == 300 * once
    (row,) = repeats._by_document(spans).collect()
    assert len(row["lows"]) == len(row["highs"]) == once
    assert result(make_docs(pairs)) == expected(pairs)


def test_empty_table(make_docs):
    assert result(make_docs([(1, "x")]).limit(0)) == []


def test_maximal_repeats_are_all_found():
    """Aligned contexts of one anchor: every common string of 200 bytes lies in a reported repeat."""
    rng = np.random.default_rng(5)
    base = bytes(rng.integers(97, 101, 336, dtype=np.uint8))
    contexts, before = [], []
    for _ in range(12):
        left, right = int(rng.integers(0, 137)), int(rng.integers(64, 201))
        text = bytearray(rng.integers(97, 101, 336, dtype=np.uint8))
        text[136 - left : 136 + right] = base[136 - left : 136 + right]
        cut = int(rng.integers(0, 60))
        contexts.append(bytes(text[cut:]))
        before.append(136 - cut)
    bucket = np.zeros(12, np.int64)
    covered = [set() for _ in contexts]
    for length, found in repeats.maximal_repeats(bucket, contexts, np.array(before)):
        assert len(found) > 1 and len({contexts[i][s : s + length] for i, s in found}) == 1
        for i, s in found:
            covered[i] |= set(range(s, s + length))
    seen = Counter((b - s, c[s : s + 200]) for c, b in zip(contexts, before) for s in range(len(c) - 199))
    for c, b, have in zip(contexts, before, covered):
        want = set()
        for s in range(len(c) - 199):
            if seen[b - s, c[s : s + 200]] > 1:
                want |= set(range(s, s + 200))
        assert have == want


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    out = QUERIES["op7_repeats"](spark, sf_dir).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out)
    assert got == expected([(r["doc_id"], r["text"]) for r in docs])
