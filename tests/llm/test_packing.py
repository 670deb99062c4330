"""Pieces against the tokenizer itself, plans against counts, whole sequences read back."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from layerloom.llm import packing
from layerloom.llm.queries import QUERIES

TOKENIZER = Tokenizer.from_file(packing.DEFAULT_TOKENIZER)


def ids_of(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check(rows, pairs, capacity):
    """Every row's pieces in order, every sequence gapless and within its capacity."""
    want = Counter()
    for key, text in pairs:
        ids = ids_of(text)
        for n, at in enumerate(range(0, len(ids), capacity)):
            want[(key, n, at, len(ids[at : at + capacity]), crc(ids[at : at + capacity]))] += 1
    assert Counter((r["key"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [16, 2048])
def test_odd_rows(spark, make_docs, odd_pairs, capacity):
    pairs = odd_pairs + [(30, "x<|endoftext|>y <|startoftext|>"), (31, "tab\tnew\nline hard em"), (32, "é ́x")]
    pairs += [(33, "word" * 3000), (34, "ΑΣ ΟΔΟΣ ŒUVRE İstanbul"), (35, "don't it's\x1cwe'll\x85x")]
    docs = make_docs(pairs).repartition(3)
    check(packing.pack(docs, capacity=capacity).collect(), pairs, capacity)
    assert packing.pack(docs.limit(0)).count() == 0


def test_sequences_hold_the_documents(spark, make_docs, odd_pairs):
    packed = packing.pack(make_docs(odd_pairs), capacity=64, with_ids=True)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    back = defaultdict(list)
    for r in packed.orderBy("key", "piece").collect():
        held = whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert held == r["ids"] and crc(held) == r["ids_crc32"]
        back[r["key"]] += held
    assert all(back[k] == ids_of(t) for k, t in odd_pairs if k is not None and k != 2)


def test_query(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    rows = QUERIES["op12_packing"](spark, sf_dir).withColumnRenamed("doc_id", "key").collect()
    used = check(rows, docs, packing.CAPACITY)
    lengths = np.bincount([r["length"] for r in rows], minlength=packing.CAPACITY + 1)
    assert used <= sum(n for n, _ in packing.best_fit(lengths, packing.CAPACITY))


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="aZéßİΣ 中\n\t'st1<|.▁😀́≠\x1c\x85", max_size=40))
def test_words_join_to_the_tokenizer_s_ids(text):
    words = _known.get("it") or _known.setdefault("it", packing.Words(open(packing.DEFAULT_TOKENIZER).read()))
    (found,) = list(words.ids([text]))
    assert np.frombuffer(found, "<u4").tolist() == ids_of(text)[:-1]


_known: dict = {}


def plain_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= n]
        if fits:
            gaps.remove(min(fits))
            gaps.append(min(fits) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


@settings(deadline=None, max_examples=60)
@given(st.lists(st.integers(1, 24), max_size=80))
def test_plan_uses_each_piece_once(lengths):
    counts = np.bincount(lengths, minlength=25)
    assert sum(n for n, _ in packing.best_fit(counts, 24)) == plain_best_fit(lengths, 24)
    planned = packing.plan(counts, 24)
    used = Counter()
    for many, of in planned:
        assert many > 0 and sum(n * times for n, times in of.items()) <= 24
        for n, times in of.items():
            used[n] += many * times
    assert used == Counter(lengths)
    places, taken = packing.Places(planned), Counter()
    spots = set()
    for n in lengths:
        sequence, offset = places(np.array([n]), np.array([taken[n]]))
        taken[n] += 1
        spots |= {(int(sequence[0]), int(offset[0]) + i) for i in range(n)}
    assert len(spots) == sum(lengths)
    assert sum(m for m, _ in planned) <= plain_best_fit(lengths, 24)


def test_exact_fillings_leave_no_gap():
    """Singles, pairs and triples that fill sequences exactly are found."""
    counts = np.zeros(101, int)
    for n, many in ((90, 7), (10, 7), (70, 5), (19, 5), (11, 5), (60, 3), (23, 3), (15, 3), (2, 3)):
        counts[n] = many
    planned = packing.plan(counts, 100)
    assert sum(m for m, _ in planned) == 15 and all(sum(n * t for n, t in of.items()) == 100 for _, of in planned)


def test_a_length_that_a_third_of_all_pieces_have(spark, make_docs):
    pairs = [(i, "same words here") for i in range(700)] + [(700 + i, "word " * (i % 97)) for i in range(1400)]
    rows = packing.pack(make_docs(pairs).repartition(6), capacity=100).collect()
    used = check(rows, pairs, 100)
    assert used == -(-sum(len(ids_of(t)) for _, t in pairs) // 100)
