"""Alignment of two tokenizers' tokens over the same bytes by galloping intersection.

Tokenizer A is a byte-level one, B a piece one; both read a space and the text.
Each token ends at a byte offset. The ends both share are found by galloping: the
shorter list of ends drives, each of its ends is bracketed in the longer list by
steps that double and then found by binary search from there. Common ends cut the
tokens into groups; differences of their ranks are the ranges of tokens in a group.

Some places always part both tokenizers' tokens: before a space between two
characters that aren't white space, and between a Latin letter and an ASCII sign or
digit. A splits there before merging, and B has no piece that reaches across, which
is checked when B is read. Their offsets are thus common ends, so a text is a row of
stretches between them, and a task tokenises and aligns those it hasn't met, end to
end, and remembers them. Texts with other characters are parted at spaces only.

A text is read once: its numbers and id pairs are written down. How many documents
hold a pair linked is counted from these over the whole corpus, first within tasks,
and documents then add up the counts of their links. Counts of the
``FREQUENT`` most frequent pairs at most are broadcast; links of all other pairs
are joined with theirs. Which way a pair goes changes no result.

NULL and empty texts, and texts that the tokens of A or B don't give back byte by
byte, have no tokens. Repeated rows are documents of their own; keys may be NULL.
An empty table gives no rows. Special tokens' strings in a text are plain text.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate, chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import cut
from layerloom.llm.vocabularies import Memo, Spelling, byte_alphabet, plain_letters

DEFAULT_A = "/opt/tokenizers/byte_bpe_50k.json"
DEFAULT_B = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs whose counts are broadcast at most (17 bytes each).
FREQUENT = 1_000_000
#: Stretches remembered per task, the longest that is, texts read at once and pairs counted in a task; all bound memory only.
MEMO, MEMO_LENGTH, TEXTS, COUNTED = 150_000, 64, 256, 1_000_000
#: Pairs as one number: the id of A, then that of B.
B_BITS = 32

_PARTING = re.compile(r"(?<=\S) (?=\S)")


def common_ends(shorter: list[int], longer: list[int]) -> tuple[list[int], list[int]]:
    """Ranks in both ascending lists of the values that both have."""
    in_shorter, in_longer = [], []
    low, n = 0, len(longer)
    for rank, end in enumerate(shorter):
        if low == n:
            break
        if longer[low] < end:
            step, high = 1, low + 1
            while high < n and longer[high] < end:
                low, step = high, 2 * step
                high += step
            low = bisect_left(longer, end, low + 1, min(high + 1, n))
            if low == n:
                break
        if longer[low] == end:
            in_shorter.append(rank)
            in_longer.append(low)
            low += 1
    return in_shorter, in_longer


@dataclass
class Aligned:
    """Tokens of several stretches laid end to end, and their groups."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    #: Ranges of ranks, a row for each group: from and to in A, from and to in B.
    ranges: np.ndarray
    #: Groups of each stretch: those from one of these up to the next.
    edges: list[int]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The id pair of each link, group by group, and links before each stretch's first (and all)."""
        low_a, high_a, low_b, high_b = self.ranges.T
        wide = high_b - low_b
        sizes = (high_a - low_a) * wide
        ends = np.cumsum(sizes)
        nth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
        wide = np.repeat(wide, sizes)
        a = self.ids_a[np.repeat(low_a, sizes) + nth // np.maximum(wide, 1)]
        b = self.ids_b[np.repeat(low_b, sizes) + nth % np.maximum(wide, 1)]
        return a << B_BITS | b, np.concatenate([[0], ends])[self.edges]


class Tokenizers:
    """Both tokenizers, how texts part, and the bytes of each token."""

    def __init__(self, a: str, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.model, self.spelling = self.a.model, Spelling()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        alphabet = byte_alphabet()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(alphabet[c] for c in entry) if set(entry) <= alphabet.keys() else entry.encode()
        letters = plain_letters(self.a)
        mixed = re.compile(rf"[{letters}][!-@\[-`{{-~]|[!-@\[-`{{-~][{letters}]")
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        joining = [p for i, p in enumerate(pieces) if not self.b.is_byte(i) and not self.b.is_control(i) and not self.b.is_unknown(i)]
        joining = [p for p in joining if "▁" in p.lstrip("▁") or "\n" in p or mixed.search(p.lstrip("▁"))]
        self.before = self.b.encode("\n")  # what comes before a stretch without a space
        if joining or len(self.before) != 2:
            raise ValueError(f"tokenizer B merges across the places where texts are parted, as in {joining[:3]}")
        self.bytes_b = [
            bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.foreign = re.compile(rf"[^ \t-\r!-~{letters}]").search
        self.letters = re.compile(rf" ?[{letters}]+").fullmatch
        self.part = re.compile(
            rf" ?[{letters}]+| ?(?:[^{letters} \t-\r']|'[{letters}]*)+|\n(?=[^ \t-\r])|[ \t-\r]+[^ \t-\r]*"
        ).findall

    def stretches(self, text: str) -> list[str]:
        """Parts of a space and the text that neither tokenizer's tokens reach across."""
        if not self.foreign(text):
            return self.part(" " + text)
        out = []
        for s in _PARTING.split(text):
            out += [" " + s] if self.foreign(s) or s.startswith(" ") else self.part(" " + s)
        return out

    def ids(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for each stretch; only one that starts with a space has a text's first piece of B."""
        asked = [s for s in stretches if not self.letters(s)]
        of_a = dict(zip(asked, self.a.encode_batch_fast(asked, add_special_tokens=False)))
        spelling, tokenize = self.spelling, self.model.tokenize
        ids_a = [of_a[s].ids if s in of_a else [t.id for t in tokenize(s.translate(spelling))] for s in stretches]
        of_b = self.b.encode([s[1:] if s[0] == " " else "\n" + s for s in stretches], num_threads=1)
        return ids_a, [ids if s[0] == " " else ids[2:] for s, ids in zip(stretches, of_b)]

    def _given_back(self, stretches: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> list[int]:
        """Which stretches both tokenizers' tokens give back byte by byte."""
        get_a, get_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        return [
            i
            for i, (s, a, b) in enumerate(zip(stretches, ids_a, ids_b))
            if b"".join(map(get_a, a)) == s.encode() == b"".join(map(get_b, b))
        ]

    def aligned(self, stretches: list[str]) -> tuple[list[str], Aligned]:
        """The stretches whose bytes both tokenizers give back, and their tokens and groups."""
        ids_a, ids_b = self.ids(stretches)
        found = self._laid_out(stretches, ids_a, ids_b)
        if found is None:
            kept = self._given_back(stretches, ids_a, ids_b)
            stretches, ids_a, ids_b = ([x[i] for i in kept] for x in (stretches, ids_a, ids_b))
            found = self._laid_out(stretches, ids_a, ids_b)
        return stretches, found

    def _laid_out(self, stretches: list[str], ids_a: list[list[int]], ids_b: list[list[int]]) -> Aligned | None:
        """Tokens and groups of the stretches end to end; None if some stretch is not given back."""
        sides = [list(chain.from_iterable(ids)) for ids in (ids_a, ids_b)]
        tokens = [list(map(table.__getitem__, ids)) for table, ids in zip((self.bytes_a, self.bytes_b), sides)]
        whole = "".join(stretches).encode()
        if any(b"".join(t) != whole for t in tokens):
            return None
        ends_a, ends_b = (list(accumulate(map(len, t))) for t in tokens)
        if len(ends_a) <= len(ends_b):
            at_a, at_b = common_ends(ends_a, ends_b)
        else:
            at_b, at_a = common_ends(ends_b, ends_a)
        borders = np.cumsum([0, *map(len, map(str.encode, stretches))])
        met = np.array([0, *map(ends_a.__getitem__, at_a)])
        edges = np.searchsorted(met, borders)
        if not np.array_equal(met[edges], borders):
            return None
        ends = np.array([[-1, *at_a], [-1, *at_b]], np.int64) + 1
        ranges = np.stack([ends[0, :-1], ends[0, 1:], ends[1, :-1], ends[1, 1:]], axis=1)
        return Aligned(*(np.array(ids, np.int64) for ids in sides), ranges, edges.tolist())


class Stretches(Memo):
    """What ``made`` makes of each stretch met so far in a task; None of one whose bytes are not given back."""

    def __init__(self, tokenizers: Tokenizers, made):
        super().__init__(MEMO)
        self.tokenizers, self.made = tokenizers, made
        #: Stretches that are not given back.
        self.lost: set[str] = set()

    def _learn(self, stretches: list[str]) -> None:
        kept, found = self.tokenizers.aligned(stretches)
        self.update(zip(kept, self.made(found)))
        if len(kept) < len(stretches):
            lost = set(stretches).difference(kept)
            self.update(dict.fromkeys(lost))
            self.lost |= lost

    def texts(self, texts: list[str | None]):
        """The parts of each text, none for a text without tokens."""
        split = [self.tokenizers.stretches(t) if t else [] for t in texts]
        new = self.unknown(set().union(*split))
        if new:
            self._learn(new)
        get = self.__getitem__
        for text, parts in zip(texts, split):
            if self.lost and not self.lost.isdisjoint(parts):  # the bytes of the whole text decide
                new.append(" " + text)
                self._learn(new[-1:])
                parts = [new[-1]] if self[new[-1]] is not None else []
            yield list(map(get, parts))
        for s in new:
            if len(s) > MEMO_LENGTH:
                self.pop(s, None)
        self.tidy()
        self.lost = {s for s in self.lost if s in self or s in self.old}


def _shared(docs: DataFrame, a: str, b: str):
    """The two files, a few MB whose size has nothing to do with the documents."""
    with open(a, encoding="utf-8") as file_a, open(b, "rb") as file_b:
        return docs.sparkSession.sparkContext.broadcast((file_a.read(), file_b.read()))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))


#: Of each row: its number here, tokens of A and of B, groups, and its id pairs with their links, compressed.
FOUND = "id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_pairs int, pairs binary"


def _links(docs: DataFrame, a: str, b: str, key: str, text: str) -> DataFrame:
    """``key`` and ``FOUND`` of every row."""
    files = _shared(docs, a, b)
    rows = _texts(docs, key, text)

    def made(found):
        """Tokens of A and B in one number, id pairs of links, groups as text."""
        pairs, bounds = found.links()
        pairs, bounds = pairs.tobytes(), (bounds * 8).tolist()
        show_a, show_b = list(map(str, found.ids_a.tolist())), list(map(str, found.ids_b.tolist()))
        shown = [f"{','.join(show_a[p:q])}|{','.join(show_b[r:s])}" for p, q, r, s in found.ranges.tolist()]
        of_group = np.concatenate([[[0, 0]], found.ranges[:, 1::2]])[found.edges]  # tokens before each stretch
        tokens = np.diff(of_group[:, 0] + (of_group[:, 1] << B_BITS)).tolist()
        edges = found.edges
        return [
            (n, pairs[p:q], ";".join(shown[low:high]))
            for n, (p, q), (low, high) in zip(tokens, pairwise(bounds), pairwise(edges))
        ]

    def read(batches):
        known = Stretches(Tokenizers(*files.value), made)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                out = []
                for parts in known.texts(part.column("text").to_pylist()):
                    if not parts:
                        out.append((number, 0, 0, 0, "", 0, b""))
                    else:
                        tokens = sum([p[0] for p in parts])
                        shown = ";".join([p[2] for p in parts])
                        pairs, times = np.unique(np.frombuffer(b"".join([p[1] for p in parts]), np.int64), return_counts=True)
                        digest = hashlib.sha256(shown.encode()).hexdigest()
                        held = zlib.compress(pairs.tobytes() + times.astype(np.int64).tobytes(), 1)
                        n_b = tokens >> B_BITS
                        out.append((number, tokens - (n_b << B_BITS), n_b, shown.count("|"), digest, len(pairs), held))
                    number += 1
                kinds = [pa.int64()] * 4 + [pa.string(), pa.int32(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([part.column("key"), *columns], names=["key", *_NAMES])

    return rows.mapInArrow(read, f"key {rows.schema['key'].dataType.simpleString()}, {FOUND}")


_NAMES = [c.split()[0] for c in FOUND.split(", ")]


def _read_back(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and links of all rows of a batch, and where each row's begin."""
    sizes = batch.column("n_pairs").to_numpy()
    held = [np.frombuffer(zlib.decompress(p), np.int64) for p in batch.column("pairs").to_pylist() if p]
    both = [(h[: len(h) // 2], h[len(h) // 2 :]) for h in held]
    pairs, times = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (zip(*both) if both else ((), ())))
    return pairs, times, np.concatenate([[0], np.cumsum(sizes)])


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            yield batch.slice(at, TEXTS)


def _count(batches):
    held: Counter = Counter()

    def out():
        columns = [pa.array(list(c), pa.int64()) for c in (held.keys(), held.values())]
        held.clear()
        return pa.RecordBatch.from_arrays(columns, names=["pair", "n"])

    for part in _slices(batches):
        found, n = np.unique(_read_back(part)[0], return_counts=True)
        held.update(dict(zip(found.tolist(), n.tolist())))
        if len(held) > COUNTED:
            yield out()
    yield out()


def _pair_counts(found: DataFrame) -> DataFrame:
    """``pair`` and ``n``, how many rows hold it linked."""
    return found.select("n_pairs", "pairs").mapInArrow(_count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _most_frequent(ranked: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, counts and whether best of at most ``most`` pairs, those with the highest powers of two in their counts."""
    sizes = ranked.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).count().collect()
    lowest, total = 64, 0
    for power, n in sorted(sizes, reverse=True):
        if total + n > most:
            break
        lowest, total = power, total + n
    table = ranked.where(F.floor(F.log2("n")) >= lowest).select("pair", "n", "best").toArrow()
    pair, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    return pair[order], n[order], best[order]


def align(
    docs: DataFrame,
    *,
    a: str = DEFAULT_A,
    b: str = DEFAULT_B,
    key: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every row."""
    found = cut(_links(docs, a, b, key, text))
    of_a = Window.partitionBy(F.shiftright("pair", B_BITS))  # at most as many pairs as B has ids
    ranked = cut(_pair_counts(found).withColumn("best", (F.col("n") == F.max("n").over(of_a)).cast("bigint")))
    top = docs.sparkSession.sparkContext.broadcast(_most_frequent(ranked, frequent))
    kept = ["key", "id", "n_a", "n_b", "n_groups", "groups_sha256"]

    def sums(batches):
        """Sums over the links of the most frequent pairs, and the other pairs with their links."""
        known, counts, best = top.value
        for part in _slices(batches):
            pairs, times, edges = _read_back(part)
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            met = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            added = np.zeros((3, len(pairs) + 1), np.int64)
            added[0, 1:] = np.cumsum(times)
            if len(known):
                added[1:, 1:] = np.cumsum(np.where(met, times * [best[at], counts[at]], 0), axis=1)
            rest = np.flatnonzero(~met)
            offsets = pa.array(np.searchsorted(rest, edges), pa.int32())
            links = pa.StructArray.from_arrays([pa.array(pairs[rest]), pa.array(times[rest])], names=["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), *map(pa.array, np.diff(added[:, edges], axis=1)), pa.ListArray.from_arrays(offsets, links)],
                names=[*kept, "n_links", "n_best", "count_sum", "others"],
            )

    kinds = ", ".join(f"{c} {found.schema[c].dataType.simpleString()}" for c in kept)
    summed = found.select(*kept, "n_pairs", "pairs").mapInArrow(
        sums, f"{kinds}, n_links bigint, n_best bigint, count_sum bigint, others array<struct<pair: bigint, times: bigint>>"
    )
    others = summed.select("id", F.inline("others"))
    met = others.join(ranked, "pair").groupBy("id").agg(
        F.sum(F.col("times") * F.col("best")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_count")
    )
    return summed.join(met, "id", "left").select(
        "key",
        *NUMBERS[:4],
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_count", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def token_groups(
    docs: DataFrame, *, a: str = DEFAULT_A, b: str = DEFAULT_B, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key`` and the ``groups`` of every row: the ids of A and of B in each, in order."""
    files = _shared(docs, a, b)
    rows = _texts(docs, key, text)

    def made(found):
        ids_a, ids_b = found.ids_a.tolist(), found.ids_b.tolist()
        shown = [{"a": ids_a[p:q], "b": ids_b[r:s]} for p, q, r, s in found.ranges.tolist()]
        return [shown[low:high] for low, high in pairwise(found.edges)]

    def split(batches):
        known = Stretches(Tokenizers(*files.value), made)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                found = [
                    [group for p in parts for group in p]
                    for parts in known.texts(part.column("text").to_pylist())
                ]
                kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(found, kind)], names=["key", "groups"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(split, f"key {kind}, groups array<struct<a: array<int>, b: array<int>>>")
