"""Alignment against the tokenizers run over whole texts, and galloping against sets."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import accumulate, product

import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer, decoders

from layerloom.llm import alignment
from layerloom.llm.queries import QUERIES
from layerloom.llm.vocabularies import byte_alphabet

A = Tokenizer.from_file(alignment.DEFAULT_A)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=alignment.DEFAULT_B)
ALPHABET = byte_alphabet()


def plain_groups(text):
    """(ids of A, ids of B) per group, over the whole text at once; none if bytes are lost."""
    if not text:
        return []
    whole = b" " + text.encode()
    ids_a, ids_b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    bytes_a = [bytes(ALPHABET[c] for c in A.id_to_token(i)) for i in ids_a]
    bytes_b = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [B.id_to_piece(i)]]
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []
    ends_a, ends_b = list(accumulate(map(len, bytes_a))), list(accumulate(map(len, bytes_b)))
    both = sorted(set(ends_a) & set(ends_b))
    out = [([], []) for _ in both]
    for side, (ends, ids) in enumerate(((ends_a, ids_a), (ends_b, ids_b))):
        for end, i in zip(ends, ids):
            out[bisect_left(both, end)][side].append(i)
    return out


def plain_rows(texts):
    found = [plain_groups(t) for t in texts]
    links = [Counter(p for a, b in g for p in product(a, b)) for g in found]
    count = Counter(p for of in links for p in of)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    out = []
    for g, of in zip(found, links):
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((
            sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(of.values()),
            sum(n for p, n in of.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in of.items()),
            hashlib.sha256(shown.encode()).hexdigest() if g else "",
        ))
    return out


ODD = [
    "a  b", " lead", "trail ", "\nline\nbreak \n x", "tab\t tab", "<|endoftext|> <s> </s> <unk> <0x0A>", "▁lower block", "x ▁ y",
    "é ́  hard  em 　", "naïve café 中文字符 かな 😀😀 done", "don't it's we'll I'm", "1234567 12,345.67",
    "\x00nul \x1c fs\x85 nel", "x\x1fy z'tq ''re !'s 3rd _foo a1b2 (x) \r\n\n\n  y \n z\n", "a" * 500, "🙂" * 40, " ", "  ", "\n", "ﬁ ﷺ İ", "العربية हिन्दी ไทย",
]


def shown(df, key="key"):
    columns = (*alignment.NUMBERS, "groups_sha256")
    return sorted((str(r[key]), *(r[c] for c in columns)) for r in df.collect())


@pytest.mark.parametrize("frequent", [0, 40, alignment.FREQUENT])
def test_odd_rows(spark, make_docs, odd_pairs, frequent):
    pairs = odd_pairs + list(enumerate(ODD, 100))
    docs = make_docs(pairs).repartition(3)
    want = sorted((str(k), *row) for (k, _), row in zip(pairs, plain_rows([t for _, t in pairs])))
    assert shown(alignment.align(docs, frequent=frequent)) == want
    assert alignment.align(docs.limit(0)).count() == 0


def test_groups_of_odd_rows(spark, make_docs):
    docs = make_docs(list(enumerate(ODD)))
    found = {r["key"]: [(g["a"], g["b"]) for g in r["groups"]] for r in alignment.token_groups(docs).collect()}
    assert found == {i: plain_groups(t) for i, t in enumerate(ODD)}
    assert any(not g for g in found.values()) and any(len(a) > 1 and len(b) > 1 for g in found.values() for a, b in g)


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((str(r["doc_id"]), *row) for r, row in zip(rows, plain_rows([r["text"] for r in rows])))
    assert shown(QUERIES["op13_alignment"](spark, sf_dir), "doc_id") == want


@given(st.sets(st.integers(1, 200)), st.sets(st.integers(1, 200)))
def test_common_ends(one, two):
    one, two = sorted(one), sorted(two)
    both = sorted(set(one) & set(two))
    assert alignment.common_ends(one, two) == ([one.index(v) for v in both], [two.index(v) for v in both])


def test_byte_alphabet_is_the_decoder_s():
    decoder = decoders.ByteLevel()
    assert len(ALPHABET) == 256
    for shown, byte in ALPHABET.items():
        if byte < 128:
            assert decoder.decode([shown]) == chr(byte)


@given(st.text(alphabet="aZé 中\n\t'1<.▁😀́ İ", max_size=40))
def test_stretches_join_to_the_whole_text(text):
    if "it" not in _known:
        with open(alignment.DEFAULT_A) as a, open(alignment.DEFAULT_B, "rb") as b:
            _known["it"] = alignment.Tokenizers(a.read(), b.read())
    tokenizers = _known["it"]
    if text:
        assert "".join(tokenizers.stretches(text)) == " " + text

    def made(found):
        a, b = found.ids_a.tolist(), found.ids_b.tolist()
        shown = [(a[p:q], b[r:s]) for p, q, r, s in found.ranges.tolist()]
        return [shown[low:high] for low, high in zip(found.edges, found.edges[1:])]

    (parts,) = list(alignment.Stretches(tokenizers, made).texts([text]))
    assert [g for p in parts for g in p] == plain_groups(text)


_known: dict = {}
