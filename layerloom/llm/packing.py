"""Packing of tokenised documents into sequences by exact-complement hashing.

A document is its token ids and one end id. Documents longer than a sequence are
cut into pieces of a whole sequence; the last piece may be shorter. Only the
number of pieces of each length matters to the packing, at most ``capacity``
numbers, so the plan is made on the driver from those counts however many pieces
there are:

1. Longest lengths first, a sequence is opened and its gap looked up in tables of
   the sums that one available length has, then two, then three. A combination
   that fills the gap exactly is consumed as often as its lengths' counts allow.
2. Then, where none does, the longest length that fits goes in first and the new
   gap is looked up again.
3. Lengths that no combination completes are packed best fit decreasing.

Exact fillings can use up short lengths that long ones will lack, so plans that
stop after singles, pairs or triples, with and without step 2, are compared and
the one with fewest sequences is taken. All steps handle equal sequences together, so the plan has a row for each length
of each distinct sequence. Each piece knows its place among its task's pieces of
its length; adding the earlier tasks' counts gives its place among all, and with
it a place in the plan. No piece meets another in a task.

NULL and empty texts are the end id alone. Every row counts, repeated ones too;
keys may be NULL. An empty table gives no rows. Special tokens' strings in a text
become their ids, as the tokenizer does by itself.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import cut, text_or_empty
from layerloom.llm.vocabularies import Memo, Spelling, plain_letters

DEFAULT_TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
#: Words remembered per task, the longest that is, and texts tokenised at once; all bound memory only.
MEMO_WORDS, MEMO_LENGTH, TEXTS = 250_000, 64, 128

_BLANK = re.compile(r"[ \t-\r]+")


class Words:
    """Ids, as little-endian 32-bit numbers, of texts.

    The tokenizer normalises, lower-cases, drops white space and splits runs of
    letters, digits and other signs before it merges. Texts of ASCII and plain Latin
    letters are split here by the same rules, so that "Word," and "word." share what
    a task remembers; words with any other character go to the tokenizer whole.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model, self.spelling, self.memo = self.tokenizer.model, Spelling(), Memo(MEMO_WORDS)
        letters = plain_letters(self.tokenizer)
        low = "".join(sorted(set(letters.lower())))
        self.foreign = re.compile(rf"[^ \t-\r!-~{letters}]|<\|")  # special tokens begin with the latter
        self.split = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{low}]+|[0-9]|[^ \t-\r0-9{low}]+").findall

    def _parts(self, text: str, whole: set[str]) -> list[str]:
        """What the text's ids are made of; words for the tokenizer are put into ``whole`` too."""
        if not self.foreign.search(text):
            return self.split(text.lower())
        parts = []
        for word in _BLANK.split(text):
            if self.foreign.search(word):
                whole.add(word)
                parts.append(word)
            else:
                parts += self.split(word.lower())
        return parts

    def ids(self, texts: list[str]):
        """The ids of each text, as bytes."""
        whole: set[str] = set()
        split = [self._parts(t, whole) for t in texts]
        memo, spelling, tokenize = self.memo, self.spelling, self.model.tokenize
        new = memo.unknown(set().union(*split))
        asked = [w for w in new if w in whole]
        for word, found in zip(asked, self.tokenizer.encode_batch_fast(asked, add_special_tokens=False)):
            memo[word] = array("I", found.ids).tobytes()
        for word in new:
            if word not in whole:
                memo[word] = array("I", [t.id for t in tokenize(word.translate(spelling))]).tobytes()
        for parts in split:
            yield b"".join(map(memo.__getitem__, parts))
        for word in new:
            if len(word) > MEMO_LENGTH:
                memo.pop(word, None)
        memo.tidy()


def pieces(
    docs: DataFrame,
    *,
    tokenizer: str = DEFAULT_TOKENIZER,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32`` (and ``ids``) of every piece, with its task and place there."""
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # the vocabulary: a few MB, fixed
    rows = docs.select(F.col(key).alias("key"), text_or_empty(text).alias("text"))
    names = ["key", "piece", "start", "length", "ids_crc32", "part", "place"] + (["ids"] if with_ids else [])
    end = np.array([END_ID], "<u4").tobytes()

    def cut_up(batches):
        words, task, seen = Words(shared.value), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                of, out = [], []
                for row, found in enumerate(words.ids(part.column("text").to_pylist())):
                    ids = found + end
                    for n, low in enumerate(range(0, len(ids), 4 * capacity)):
                        held = ids[low : low + 4 * capacity]
                        size = len(held) // 4
                        of.append(row)
                        out.append((n, low // 4, size, zlib.crc32(held), task, seen[size], held))
                        seen[size] += 1
                columns = list(zip(*out))
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(h, "<u4").astype(np.int32) for h in columns[6]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(of)), *arrays], names=names)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint"
    return rows.mapInArrow(cut_up, schema + (", ids array<int>" if with_ids else ""))


class Complements:
    """Which sums one, two and three of the available lengths have; tables are addressed by the sum."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.pairs: np.ndarray | None = None
        self.refresh()

    def refresh(self) -> None:
        """Index the sums of pairs anew, once a length has run out."""
        has = self.counts > 0
        if self.pairs is not None and np.array_equal(has, self.has):
            return
        self.has = has
        self.longest = int(np.flatnonzero(has)[-1]) if has.any() else 0
        width = 2 * len(has)
        spectrum = np.fft.rfft(has.astype(float), width)
        self.pairs = np.rint(np.fft.irfft(spectrum * spectrum, width))[: len(has)] > 0

    def _left(self, length: int, used: Counter) -> int:
        return int(self.counts[length]) - used[length]

    def _pair(self, total: int, used: Counter) -> tuple[int, ...] | None:
        """Two lengths of this sum, the longer one as long as can be."""
        if total < 2 or not self.pairs[total]:
            return None
        longer = np.arange(min(total - 1, self.longest), (total - 1) // 2, -1)
        for a in longer[self.has[longer] & self.has[total - longer]].tolist():
            b = total - a
            if self._left(a, used) > (a == b) and self._left(b, used) > 0:
                return a, b
        return None

    def filling(self, gap: int, used: Counter, most: int = 3) -> tuple[int, ...] | None:
        """Up to ``most`` available lengths, as few as can be, that add up to ``gap`` beside those used."""
        if gap > most * self.longest:
            return None
        if self.has[gap] and self._left(gap, used) > 0:
            return (gap,)
        if most > 1 and (pair := self._pair(gap, used)):
            return pair
        if most < 3:
            return None
        first = np.arange(min(gap - 2, self.longest), 0, -1)
        for a in first[self.has[first] & self.pairs[gap - first]].tolist():
            if self._left(a, used) > 0 and (pair := self._pair(gap - a, used + Counter([a]))):
                return a, *pair
        return None

    def fitting(self, gap: int, used: Counter) -> int:
        """The longest available length that fits, 0 if none does."""
        for a in np.flatnonzero(self.has[: gap + 1])[::-1].tolist():
            if self._left(a, used) > 0:
                return a
        return 0

    def take(self, used: Counter) -> int:
        """Consume ``used`` as often as it can be; how often that is."""
        times = min(int(self.counts[a]) // n for a, n in used.items())
        for a, n in used.items():
            self.counts[a] -= n * times
        self.refresh()
        return times


Sequences = list[tuple[int, Counter]]


def _planned(counts: np.ndarray, capacity: int, most: int, deep: bool) -> Sequences:
    """One plan: exact fillings of up to ``most`` lengths, then ``deep`` ones, then best fit."""
    counts, out = counts.copy(), []
    index = Complements(counts)
    for width in [*range(1, most + 1), *([0] if deep else [])]:
        for length in range(capacity - 1, 0, -1):
            while counts[length]:
                used, gap = Counter([length]), capacity - length
                filled = index.filling(gap, used, width or most)
                while not width and filled is None and (longest := index.fitting(gap, used)):
                    used[longest] += 1
                    gap -= longest
                    filled = index.filling(gap, used, most)
                if filled is None:
                    break
                used += Counter(filled)
                out.append((index.take(used), used))
    return out + best_fit(counts, capacity)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> Sequences:
    """Distinct sequences, (how many, how often each length is in one); ``counts[n]`` pieces have length n."""
    counts = counts.astype(np.int64).copy()
    whole = [(int(counts[capacity]), Counter({capacity: 1}))] if counts[capacity] else []
    counts[capacity] = 0
    tried = [_planned(counts, capacity, most, deep) for most in (1, 2, 3) for deep in (False, True)]
    return whole + min(tried, key=lambda found: sum(many for many, _ in found))


def best_fit(counts: np.ndarray, capacity: int) -> Sequences:
    """Best fit decreasing, equal open sequences together."""
    by_gap: dict[int, list[tuple[int, Counter]]] = {}
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        for gap in [*sorted(g for g in by_gap if g >= length), capacity]:
            room = gap // length
            while left and (gap == capacity or by_gap.get(gap)):
                many, used = (left // room, Counter()) if gap == capacity else by_gap[gap].pop()
                whole = min(many, left // room)
                left -= whole * room
                rest = min(left, room) if whole < many or gap == capacity else 0
                left -= rest
                if whole:
                    by_gap.setdefault(gap - room * length, []).append((whole, used + Counter({length: room})))
                if rest:
                    by_gap.setdefault(gap - rest * length, []).append((1, used + Counter({length: rest})))
                untouched = many - whole - bool(rest)
                if gap != capacity and untouched > 0:
                    by_gap.setdefault(gap, []).append((untouched, used))
                    if not left:
                        break
    return [x for group in by_gap.values() for x in group]


class Places:
    """Where the piece at some place among those of its length goes."""

    def __init__(self, sequences: Sequences):
        rows, given, first = [], Counter(), 0
        for many, used in sequences:
            offset = 0
            for length, n in sorted(used.items(), reverse=True):
                rows.append((length, given[length], first, n, offset))
                given[length] += many * n
                offset += length * n
            first += many
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.lengths, self.first_place, self.first_sequence, self.times, self.offsets = table.T.copy()
        self.bounds = np.searchsorted(self.lengths, np.arange(1 + max([0, *given]) + 1))

    def __call__(self, length: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequence and the offset in it of each piece."""
        row = np.zeros(len(length), np.int64)
        for n in np.unique(length).tolist():
            low, high = self.bounds[n], self.bounds[n + 1]
            of = length == n
            row[of] = low + np.searchsorted(self.first_place[low:high], place[of], side="right") - 1
        past = place - self.first_place[row]
        return self.first_sequence[row] + past // self.times[row], self.offsets[row] + past % self.times[row] * length


def pack(
    docs: DataFrame,
    *,
    tokenizer: str = DEFAULT_TOKENIZER,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset`` (and ``ids``) of every piece."""
    found = cut(pieces(docs, tokenizer=tokenizer, capacity=capacity, key=key, text=text, with_ids=with_ids))
    by_task = cut(found.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # a row per length
        counts[row["length"]] = row["n"]
    # at most ``capacity`` lengths in each of a few thousand distinct sequences
    shared = docs.sparkSession.sparkContext.broadcast(Places(plan(counts, capacity)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = by_task.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    ranked = found.join(begins, ["length", "part"]).withColumn("place", F.col("place") + F.col("begin"))
    kept = ["key", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    ranked = ranked.select(*kept, "place")

    def placed(batches):
        for batch in batches:
            sequence, offset = shared.value(batch.column("length").to_numpy(), batch.column("place").to_numpy())
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset)], names=[*kept, "sequence_id", "offset"]
            )

    kinds = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in kept)
    return ranked.mapInArrow(placed, f"{kinds}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id`` and the ``ids`` of each whole sequence, from ``pack(..., with_ids=True)``."""
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("held"))
    return held.select("sequence_id", F.flatten("held.ids").alias("ids"))
