"""Lengths against splits that are really built."""

import base64

from hypothesis import given
from hypothesis import strategies as st

from layerloom.llm.queries import QUERIES
from layerloom.llm.token_counts import DEFAULT_VOCABULARY, Automaton, read_vocabulary, token_counts


def greedy(pieces, word):
    """Number of longest matches from the front; 1 if some byte has none."""
    at, count, longest = 0, 0, max(map(len, pieces))
    while at < len(word):
        for n in range(min(longest, len(word) - at), 0, -1):
            if word[at : at + n] in pieces:
                at, count = at + n, count + 1
                break
        else:
            return 1
    return count


@given(
    st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=14),
    st.lists(st.integers(97, 99), max_size=14).map(bytes),
)
def test_same_length_as_greedy_splits(pieces, word):
    assert Automaton(pieces).length(word) == greedy(pieces, word)


def test_rows(make_docs, odd_pairs):
    pieces = set(read_vocabulary(DEFAULT_VOCABULARY))
    docs = make_docs(odd_pairs)
    out = sorted((str(r["key"]), r["n_words"], r["n_tokens"]) for r in token_counts(docs).collect())
    want = []
    for key, text in odd_pairs:
        words = (text or "").split()
        lengths = {w: greedy(pieces, b" " + w.encode()) for w in set(words)}
        want.append((str(key), len(words), sum(lengths[w] for w in words)))
    assert out == sorted(want)
    assert token_counts(docs.limit(0)).count() == 0


def test_own_vocabulary_with_unknown_words(make_docs, tmp_path):
    path = tmp_path / "pieces"
    path.write_text("\n".join(f"{base64.b64encode(p).decode()} {i}" for i, p in enumerate([b" a", b" ab", b"b", b"c"])))
    out = token_counts(make_docs([(1, "abc ac abbc xb"), (2, "c" * 1000), (3, "a" + "b" * 1000)]), vocabulary=str(path))
    assert {r["key"]: r["n_tokens"] for r in out.collect()} == {1: 2 + 2 + 3 + 1, 2: 1, 3: 1000}


def test_query(spark, sf_dir):
    pieces = set(read_vocabulary(DEFAULT_VOCABULARY))
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] for r in rows}
    for r in QUERIES["op3_token_counts"](spark, sf_dir).collect():
        words = texts[r["doc_id"]].split()[:400]
        if len(texts[r["doc_id"]].split()) <= 400:
            assert r["n_tokens"] == sum(greedy(pieces, b" " + w.encode()) for w in words)
