"""Quality scores by nearest labelled neighbours in a latent semantic space.

A text becomes a TF-IDF vector over hashed terms: its words, the shapes of its
words (case, digits, symbols) and how much of it repeats. Truncated SVD of the
labelled sample's vectors gives the latent space. Every document is compared
with every labelled vector there, in blocks of exact cosine products, and the
``NEIGHBOURS`` nearest vote with weight ``max(cosine, 0) ** SHARPNESS``.

The labelled rows learned from are the ``SAMPLE`` with the least CRC-32 of their
key's text (all, if fewer), of labelled keys that have a document; rows equal in key
and text count once. So their vectors, broadcast, are at most
``SAMPLE * RANK`` floats (2 MB). Term statistics come from that sample. Scores
use the text alone. NULL and empty texts have no terms and get the sample's
share of label 1, as does every text when nothing is labelled (0.5 then).
Labels that are NULL, or whose key has both labels, are not learned from.
"""

from __future__ import annotations

import re
import zlib
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD_TERMS, SHAPE_TERMS, STATE_TERMS = 2048, 1920, 128
TERMS = WORD_TERMS + SHAPE_TERMS + STATE_TERMS
RANK = 64
#: Columns beyond the rank, and rounds, of the subspace iteration.
SPARE, ITERATIONS = 16, 4
SAMPLE = 8192
NEIGHBOURS = 25
SHARPNESS = 4
THRESHOLD = 0.3
#: Documents, and labelled vectors, per block of products.
BLOCK = 512
#: Weight of each family of terms in a text's unit vector.
FAMILY_WEIGHT = (0.35, 1.0, 1.0)
#: Words remembered per task; bounds memory only.
MEMO_WORDS = 400_000

_UPPER, _LOWER, _DIGIT = re.compile(r"[^\W\d_a-zà-öø-ÿ]+"), re.compile(r"[^\W\d_A]+"), re.compile(r"\d+")
_RUN = re.compile(r"(\W)\1+")


def shape(word: str) -> str:
    """``Abc,`` becomes ``Aa,``; ``ABC!!`` becomes ``A!+``; runs of a symbol are marked.

    Shapes that agree in 12 characters are one term, as hashed terms are few anyway.
    """
    if word.isalpha():  # most words: one run of letters, perhaps with a capital
        if word.islower():
            return "a"
        if word[0].isupper() and word[1:].islower():
            return "Aa"
    s = _UPPER.sub("A", word)
    s = _DIGIT.sub("0", _LOWER.sub("a", s))
    return _RUN.sub(r"\1+", s)[:12]


class _Terms(dict):
    """Word and shape term of words met so far in a task, packed in one number."""

    def __missing__(self, word: str) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        of_word = zlib.crc32(word.lower().encode()) % WORD_TERMS
        packed = of_word * SHAPE_TERMS + zlib.crc32(shape(word).encode()) % SHAPE_TERMS
        if len(word) <= 64:
            self[word] = packed
        return packed


def _states(text: str, words: list[str], distinct: int) -> list[int]:
    """How much of the text repeats and what its characters are, each in a few steps."""
    n = len(words)
    again = sum(map(str.__eq__, words, words[1:]))
    lines = [x for x in text.split("\n") if x.strip()]
    fresh = len(set(lines)) / max(1, len(lines))
    spread = distinct / n
    sizes = (again / n, fresh, spread, min(1.0, len(text) / n / 20))
    return [16 * i + min(15, int(15.99 * x)) for i, x in enumerate(sizes)] + [
        16 * 4 + min(15, n.bit_length()),
        16 * 5 + min(15, int(40 * text.count("|") / n)),
    ]


def term_vector(text: str, terms: _Terms, out: np.ndarray) -> None:
    """Set ``out`` to the counts of the text's terms."""
    words = text.split()
    if not words:
        return
    packed = np.fromiter(map(terms.__getitem__, words), np.int64, len(words))
    out[:WORD_TERMS] = np.bincount(packed // SHAPE_TERMS, minlength=WORD_TERMS)
    out[WORD_TERMS : WORD_TERMS + SHAPE_TERMS] = np.bincount(packed % SHAPE_TERMS, minlength=SHAPE_TERMS)
    out[[WORD_TERMS + SHAPE_TERMS + s for s in _states(text, words, len(set(words)))]] = 1.0


def weigh(rows: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Counts to unit vectors: sublinear, weighed by rarity, family by family."""
    np.log1p(rows, out=rows)
    rows *= idf
    edges = (0, WORD_TERMS, WORD_TERMS + SHAPE_TERMS, TERMS)
    for (low, high), weight in zip(pairwise(edges), FAMILY_WEIGHT, strict=True):
        part = rows[:, low:high]
        part *= weight / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


class Model:
    """Latent space, labelled vectors in it (unit length) and their labels."""

    def __init__(self, sample: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray):
        """``sample`` has the terms and counts of each labelled text."""
        self.prior = float(labels.mean()) if len(labels) else 0.5
        filled = [len(terms) > 0 for terms, _ in sample]
        self.labels = labels[filled].astype(np.float32) if sample else np.zeros(0, np.float32)
        sample = [s for s in sample if len(s[0])]
        seen = np.zeros(TERMS)
        for terms, _ in sample:
            seen[terms] += 1
        self.idf = (np.log((1 + len(sample)) / (1 + seen)) + 1).astype(np.float32)

        def blocks():
            for at in range(0, len(sample), BLOCK):
                rows = np.zeros((len(part := sample[at : at + BLOCK]), TERMS), np.float32)
                for row, (terms, counts) in zip(rows, part, strict=True):
                    row[terms] = counts
                yield weigh(rows, self.idf)

        # right singular vectors by subspace iteration, a block of rows at a time
        rank = max(1, min(RANK + SPARE, len(sample)))
        space = np.random.default_rng(4).standard_normal((TERMS, rank))
        for _ in range(ITERATIONS if sample else 0):
            space = np.linalg.qr(sum(rows.T @ (rows @ space.astype(np.float32)) for rows in blocks()))[0]
        gram = sum(((p := rows @ space).T @ p for rows in blocks()), np.zeros((rank, rank)))
        turn = np.linalg.eigh(gram)[1][:, ::-1][:, :RANK]
        self.space = (space @ turn).astype(np.float32)
        self.vectors = np.concatenate([self.project(rows) for rows in blocks()] or [np.zeros((0, self.space.shape[1]))])
        self.vectors = self.vectors.astype(np.float32)

    def project(self, rows: np.ndarray) -> np.ndarray:
        latent = rows @ self.space
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Weighted share of label 1 among the nearest labelled vectors."""
        out = np.full(len(counts), self.prior)
        filled = np.flatnonzero(counts.any(axis=1))
        if not len(filled) or not len(self.vectors):
            return out
        latent = self.project(weigh(counts[filled], self.idf))
        cosine = np.concatenate(
            [latent @ self.vectors[at : at + BLOCK * 8].T for at in range(0, len(self.vectors), BLOCK * 8)], axis=1
        )
        k = min(NEIGHBOURS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1).astype(np.float64), 1e-6) ** SHARPNESS
        out[filled] = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def _count(texts: list[str | None], terms: _Terms) -> np.ndarray:
    rows = np.zeros((len(texts), TERMS), np.float32)
    for text, row in zip(texts, rows, strict=True):
        if text:
            term_vector(text, terms, row)
    return rows


def _sparse(batches):
    terms = _Terms()
    for batch in batches:
        texts = batch.column("text")
        found, values = [], []
        for at in range(0, len(texts), BLOCK):
            for row in _count(texts.slice(at, BLOCK).to_pylist(), terms):
                i = np.flatnonzero(row)
                found.append(i.astype(np.int16).tobytes())
                values.append(row[i].tobytes())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(found, pa.binary()), pa.array(values, pa.binary())],
            names=[*batch.schema.names[:-1], "terms", "counts"],
        )


def fit(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """From at most ``SAMPLE`` rows of ``docs`` that ``labels`` marks; their term counts come to the driver."""
    marked = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("label_key"))
        .agg(F.min(label).alias("label"), F.max(label).alias("most"))
        .where("label = most")
        .select("label_key", "label", F.crc32(F.col("label_key").cast("string")).alias("order"))
    )
    there = docs.select(F.col(key).alias("there_key"))  # keys alone are read for this
    marked = marked.join(there, F.col("label_key") == F.col("there_key"), "left_semi")
    marked = marked.orderBy("order", "label_key").limit(SAMPLE)
    found = (
        docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
        .join(F.broadcast(marked), F.col("key") == F.col("label_key"))  # SAMPLE rows at most
        .select("label", "order", "key", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text")
        .dropDuplicates(["key", "digest"])
    )
    kinds = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in ("label", "order", "key", "digest"))
    counted = found.mapInArrow(_sparse, f"{kinds}, terms binary, counts binary")
    rows = counted.orderBy("order", "key", "digest").limit(SAMPLE).select("label", "terms", "counts").collect()
    sample = [(np.frombuffer(r["terms"], np.int16), np.frombuffer(r["counts"], np.float32)) for r in rows]
    return Model(sample, np.array([float(r["label"]) for r in rows]))


def scores(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``row`` (the whole input row) and ``score`` between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct("*").alias("row"))
    at_text = docs.columns.index(text)
    kind = rows.schema["row"].dataType

    def score(batches):
        terms = _Terms()
        for batch in batches:
            texts = batch.column("row").field(at_text)
            parts = [
                shared.value.score(_count(texts.slice(at, BLOCK).to_pylist(), terms))
                for at in range(0, len(texts), BLOCK)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.concatenate(parts) if parts else np.zeros(0))], names=["row", "score"]
            )

    return rows.mapInArrow(score, f"row {kind.simpleString()}, score double")
