"""Documents that hold benchmark passages, also reworded, by latent semantic retrieval.

Texts are words of ASCII-lowered bytes between punctuation and white space, in
blocks of ``BLOCK`` words; a passage is a block and the next one. The terms are
the words of the benchmark; a term's weight falls with the root of the number of
blocks of the corpus it is in, and terms in more than ``COMMON`` of all blocks (and
more than ``FEW``) have none, unless they are among the ``RAREST`` of a benchmark item.

1. One pass over the texts stores the terms of every document's blocks; each
   term's blocks are counted from that.
2. How often two weighted terms share a passage is summed up over all passages, a
   table that the benchmark bounds. It is ``A.T @ A`` for the matrix ``A`` of all
   passages, and a randomised SVD multiplies it twice with a block of vectors, at
   first random ones; Spark does the products and the driver orthogonalises terms
   x rank numbers.
3. Every passage is compared with every item in the latent space. Where their
   product is ``NEAR`` of the item's own squared norm the passage is a candidate,
   however many other words it has. As weights are cut and the space is of limited
   rank, a second way proposes what the first may miss: of an item's ``n`` words
   ``COVER`` lets ``k`` be missing, so of its ``k + SURE`` rarest ones at least
   ``SURE`` stand in the passage with a block on either side, and each such place is
   a candidate too, which passes over no leak of ``COVER`` whatever its words are.
4. Candidates are checked by the longest common subsequence of the item's words and
   the passage with a block on either side. A document is reported where it has
   ``COVER`` of the item's words in order and, if the item has an ``answer:`` marker,
   ``ANSWER`` of the words after it. A paraphrase, proposed by the latent space, needs
   ``PARAPHRASE`` of the words only, but all words of the answer. ``found_by`` says
   which way proposed the row: ``latent``, ``words`` or ``both``.

Items over ``PROBE`` words are searched as several probes, any of which reports
the item. Each group of ``GROUP`` probes has a latent space of its own; as many as
``GROUPS`` of them share the two passes over the texts, under one vocabulary, so what
is broadcast is bounded (by 17 MB a group) however many probes there are. The norm of a passage counts its
words outside the vocabulary at the mean weight. No text is shuffled.

NULL and empty texts and items match nothing. Rows stand alone, so keys may be
NULL or repeated; a repeated item id is reported once a row.
"""

from __future__ import annotations

import copy
import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import cut, scratch, stored

BLOCK = 32
COMMON = 0.001
#: Terms in so few blocks have a weight whatever share of all blocks that is.
FEW = 1000
RAREST = 12
PROBE = 64
GROUP = 256
#: Groups of probes that the texts are read for at once.
GROUPS = 8
OVERSAMPLING = 32
COVER = 0.7
ANSWER = 0.8
#: Share of an item's squared norm that a candidate's latent product has.
NEAR = 0.2
#: Share of an item's words, in order, that a paraphrase with the item's answer has.
PARAPHRASE = 0.4
#: Words of an item's rarest that a place must have; bears on time only.
SURE = 6
#: Words handled at once in a task.
CHUNK = 500_000

_FOLD = bytes.maketrans(
    string.ascii_uppercase.encode() + string.punctuation.encode(),
    string.ascii_lowercase.encode() + b" " * len(string.punctuation),
)
_MARKER = re.compile(r"\banswer\s*:", re.I)


def words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


class Chunk:
    """Term ids (-1: none) of several texts' words, and the block each is in."""

    def __init__(self, texts: list[np.ndarray]):
        lengths = np.array([len(t) for t in texts])
        self.ids = np.concatenate(texts)
        self.starts = np.append(0, np.cumsum(lengths))
        blocks = -(-lengths // BLOCK)
        self.first_block = np.append(0, np.cumsum(blocks))
        owner = np.repeat(np.arange(len(texts)), lengths)
        self.block = self.first_block[owner] + (np.arange(len(self.ids)) - self.starts[owner]) // BLOCK
        self.last_of_text = np.zeros(self.first_block[-1], bool)
        self.last_of_text[self.first_block[1:][blocks > 0] - 1] = True

    def narrowed(self, own: np.ndarray) -> Chunk:
        """The same texts under the term ids of one group of probes; ``own`` has them by id here, the last for -1."""
        out = copy.copy(self)
        out.ids = own[self.ids]
        return out

    def terms(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block and term, once each, of the terms that ``wanted`` marks."""
        at = np.flatnonzero(wanted[self.ids])  # the last mark is that of -1
        packed = np.unique(self.block[at] * np.int64(len(wanted)) + self.ids[at])
        return packed // len(wanted), packed % len(wanted)


def chunks(texts, vocabulary: dict[bytes, int]) -> Iterator[tuple[list[int], Chunk]]:
    """Chunks of an Arrow column of texts, with the row of each text in them."""
    rows, held, size = [], [], 0
    get = vocabulary.get
    for row, text in enumerate(texts):
        found = words(text.as_py() or "")
        if not found:
            continue
        rows.append(row)
        held.append(np.fromiter((get(w, -1) for w in found), np.int32, len(found)))
        size += len(found)
        if size >= CHUNK:
            yield rows, Chunk(held)
            rows, held, size = [], [], 0
    if held:
        yield rows, Chunk(held)


class Probes:
    """Word ids of the searched passages of a group of items, and the vocabulary they span."""

    def __init__(self, items: list[tuple[object, str]]):
        self.item: list[object] = []
        self.answer: list[list[int]] = []
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[list[int]] = []
        for item, found, answer in items:
            number = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found]
            self.item.append(item)
            self.ids.append(number)
            self.answer.append([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in answer])

    @staticmethod
    def split(item: object, text: str | None) -> list[tuple[object, list[bytes], list[bytes]]]:
        found = words(text or "")
        marks = list(_MARKER.finditer(text or ""))
        answer = words(text[marks[-1].end() :]) if marks else []
        count = -(-len(found) // PROBE)
        edges = [round(i * len(found) / count) for i in range(count + 1)] if count else []
        return [(item, found[a:b], answer) for a, b in pairwise(edges)]


def weights(probes: Probes, seen: np.ndarray, blocks: int) -> np.ndarray:
    """Of each term and, last, zero for words outside the vocabulary; a term of no document has none."""
    out = np.where(seen > 0, 1 / np.sqrt(np.maximum(seen, 1)), 0.0)
    kept = seen <= max(COMMON * blocks, FEW)
    for ids in probes.ids:
        distinct = np.unique(ids)
        distinct = distinct[seen[distinct] > 0]
        kept[distinct[np.argsort(seen[distinct], kind="stable")[:RAREST]]] = True
    return np.append(np.where(kept, out, 0.0), 0.0).astype(np.float32)


def lcs(masks: dict[int, int], length: int, region: np.ndarray) -> int:
    """Length of the longest common subsequence, by bit-parallel dynamic programming."""
    left = full = (1 << length) - 1
    for w in region.tolist():
        mask = masks.get(w)
        if mask:
            both = left & mask
            left = ((left + both) | (left - both)) & full
    return length - left.bit_count()


class Needles:
    """For each term, the probes it is among the rarest words of and how often; for each probe, how many must be met."""

    def __init__(self, probes: Probes, seen: np.ndarray):
        entries, self.need = [], np.zeros(len(probes.ids), np.int64)
        for probe, ids in enumerate(probes.ids):
            n = len(ids)
            missing = n - next(k for k in range(n + 1) if k / n >= COVER)
            rarest = sorted(ids, key=lambda t: (seen[t], t))[: missing + SURE]
            self.need[probe] = len(rarest) - missing
            terms, times = np.unique(rarest, return_counts=True)
            entries += zip(terms.tolist(), [probe] * len(terms), times.tolist(), strict=True)
        term, self.probe, self.times = np.array(sorted(entries), np.int64).reshape(-1, 3).T
        self.starts = np.searchsorted(term, np.arange(len(seen) + 1))
        self.wanted = np.append(np.diff(self.starts) > 0, False)

    def places(self, chunk: Chunk) -> Iterator[tuple[int, int]]:
        """Block and probe wherever the block, the one before it and two after it have enough of the probe's words."""
        block, term = chunk.terms(self.wanted)
        n_blocks, n_probes = len(chunk.last_of_text), len(self.need)
        for at in range(0, n_blocks, 4096):
            # with the blocks around these
            low, high = max(at - 1, 0), min(at + 4098, n_blocks)
            a, b = np.searchsorted(block, [low, high])
            each = self.starts[term[a:b] + 1] - self.starts[term[a:b]]
            entry = np.repeat(self.starts[term[a:b]] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            cell = np.repeat(block[a:b] - low, each) * n_probes + self.probe[entry]
            met = np.bincount(cell, self.times[entry], minlength=(high - low) * n_probes)
            met = met.astype(np.int16).reshape(-1, n_probes)
            joins = ~chunk.last_of_text[low : high - 1, None]
            around = met.copy()
            around[1:] += met[:-1] * joins
            around[:-1] += met[1:] * joins
            around[:-2] += met[2:] * (joins[:-1] & joins[1:])
            inside = around[at - low : at - low + 4096]
            for p, probe in zip(*(x.tolist() for x in np.nonzero(inside >= self.need)), strict=True):
                yield at + p, probe


class Latent:
    """What each weighted term adds to the latent product with each probe, as a share of the probe's squared norm."""

    def __init__(self, probes: Probes, weight: np.ndarray, basis: np.ndarray):
        scaled = basis * weight[:-1, None]
        distinct = [np.unique(ids) for ids in probes.ids]
        norms = np.array([(weight[d] ** 2).sum() for d in distinct])
        items = np.array([scaled[d].sum(axis=0) for d in distinct]).reshape(len(distinct), -1)
        #: Products with probes of unit length; a probe without weighted terms has none.
        self.kernel = (scaled @ items.T / np.sqrt(np.maximum(norms, 1e-30))).astype(np.float32)
        self.need = np.where(norms > 0, NEAR * np.sqrt(norms), np.inf).astype(np.float32)
        self.weighted = weight > 0

    def places(self, chunk: Chunk) -> Iterator[tuple[int, int]]:
        """Block and probe wherever the passage from that block on is near the probe."""
        block, term = chunk.terms(self.weighted)
        n_blocks, wide = len(chunk.last_of_text), np.int64(len(self.weighted))
        packed = block * wide + term
        following = np.searchsorted(packed, packed + wide)
        both = packed[np.minimum(following, len(packed) - 1)] == packed + wide if len(packed) else packed == 0
        for at in range(0, n_blocks, 4096):
            size = min(4096, n_blocks - at)
            low, high = np.searchsorted(block, [at, at + size + 1])
            sums = np.zeros((size + 1, len(self.need)), np.float32)
            if low < high:
                some = block[low:high]
                heads = np.flatnonzero(np.append(True, some[1:] != some[:-1]))
                sums[some[heads] - at] = np.add.reduceat(self.kernel[term[low:high]], heads, axis=0)
            joins = ~chunk.last_of_text[at : at + size]
            products = sums[:-1] + sums[1:] * joins[:, None]
            # a term of both blocks counts once
            again = low + np.flatnonzero(both[low:high] & (block[low:high] < at + size))
            again = again[joins[block[again] - at]]
            np.subtract.at(products, block[again] - at, self.kernel[term[again]])
            for p, probe in zip(*(x.tolist() for x in np.nonzero(products >= self.need)), strict=True):
                yield at + p, probe


def _masks(ids: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(ids):
        out[w] = out.get(w, 0) | 1 << i
    return out


def _passage_terms(block: np.ndarray, term: np.ndarray, last_of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passage and term, by passage: a block's terms belong to its passage and the one before it in its text."""
    second = (block > 0) & ~last_of_text[block - 1]
    passage = np.append(block, block[second] - 1)
    order = np.argsort(passage, kind="stable")
    return passage[order], np.append(term, term[second])[order]


def _block_terms(rows: DataFrame, vocabulary) -> DataFrame:
    """Per chunk of texts: the terms of its blocks, how many each block has, and which blocks end a text."""

    def locate(batches):
        known = vocabulary.value
        every = np.append(np.ones(len(known), bool), False)
        for batch in batches:
            for _, chunk in chunks(batch.column("text"), known):
                block, term = chunk.terms(every)
                sizes = np.bincount(block, minlength=len(chunk.last_of_text))
                columns = (term.astype(np.int32), sizes.astype(np.int32), chunk.last_of_text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], pa.list_(k)) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.bool_()), strict=True)],
                    names=["term", "size", "last"],
                )

    return stored(rows.select("text").mapInArrow(locate, "term array<int>, size array<int>, last array<boolean>"), "terms")


def _arrays(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield [batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("term", "size", "last")]


def _count_terms(located: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """Blocks with each term, and all blocks."""

    def count(batches):
        seen = np.zeros(terms + 1, np.int64)  # the last counts the blocks
        for term, size, _ in _arrays(batches):
            seen[:-1] += np.bincount(term, minlength=terms)
            seen[-1] += len(size)
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(seen[met])], names=["term", "n"])

    out = np.zeros(terms + 1, np.int64)
    for row in located.mapInArrow(count, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out[:-1], int(out[-1])


def _shared_passages(located: DataFrame, weight, own) -> DataFrame:
    """``i``, ``j`` and ``n`` of one group's terms: the sum over passages of the product of both terms' counts."""

    def pairs(batches):
        wanted = (weight.value > 0)[own.value]  # a term of other groups counts as the last, which has no weight
        terms = np.int64(len(weight.value) - 1)
        held, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for term, size, last in _arrays(batches):
            block = np.repeat(np.arange(len(size)), size)
            use = wanted[term]
            passage, term = _passage_terms(block[use], own.value[term[use]].astype(np.int64), last)
            packed, apart = [term * terms + term], 1
            while apart < len(term) and (same := passage[apart:] == passage[:-apart]).any():
                i, j = term[apart:][same], term[:-apart][same]
                packed += [i * terms + j, j * terms + i]
                apart += 1
            met, n = np.unique(np.concatenate(packed), return_counts=True)
            held.append(met)
            counts.append(n)
            if sum(map(len, held)) > 4_000_000:  # sum up what this task holds; bounds memory only
                met, where = np.unique(np.concatenate(held), return_inverse=True)
                held, counts = [met], [np.bincount(where, np.concatenate(counts)).astype(np.int64)]
        met, where = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(where, np.concatenate(counts), minlength=len(met)).astype(np.int64)
        for at in range(0, len(met), 100_000):
            some = met[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((some // terms).astype(np.int32)),
                    pa.array((some % terms).astype(np.int32)),
                    pa.array(total[at : at + 100_000]),
                ],
                names=["i", "j", "n"],
            )

    return cut(located.mapInArrow(pairs, "i int, j int, n bigint").groupBy("i", "j").agg(F.sum("n").alias("n")))


def _product(shared: DataFrame, weight, basis: np.ndarray) -> np.ndarray:
    """``A.T @ A @ basis`` from the terms' shared passages, summed up by term."""
    scaled = shared.sparkSession.sparkContext.broadcast((basis * weight.value[:-1, None]).astype(np.float32))

    def multiply(batches):
        total = np.zeros(scaled.value.shape)
        for batch in batches:
            i, j, n = (batch.column(c).to_numpy() for c in ("i", "j", "n"))
            for at in range(0, len(i), 4096):
                order = np.argsort(i[at : at + 4096], kind="stable") + at
                rows = scaled.value[j[order]] * n[order][:, None]
                begins = np.flatnonzero(np.append(True, np.diff(i[order]) != 0))
                total[i[order][begins]] += np.add.reduceat(rows, begins, axis=0)
        touched = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(touched.astype(np.int32)), pa.array(list(total[touched]), pa.list_(pa.float64()))],
            names=["term", "row"],
        )

    out = np.zeros(basis.shape)
    # a term's rows are together, so nearly all sums are final; what is left is added here
    for row in shared.repartition("i").mapInArrow(multiply, "term int, row array<double>").toLocalIterator():
        out[row["term"]] += row["row"]
    return out * weight.value[:-1, None]


Finder = Callable[[pa.Array], list[tuple[int, object, float, float, int]]]


@dataclass(frozen=True)
class Search:
    """What finds the items of one group of probes; ``own`` has its term ids by those of the texts' chunks."""

    own: np.ndarray
    probes: Probes
    weight: np.ndarray
    outside: float
    latent: Latent
    needles: Needles


def _finder(rows: DataFrame, groups: list[Probes]) -> Finder:
    """From a pass over ``rows`` (text): what finds row, item, cover, cosine and ways in a column of texts."""
    with scratch(rows.sparkSession):
        return _fitted(rows, groups)


def _fitted(rows: DataFrame, groups: list[Probes]) -> Finder:
    context = rows.sparkSession.sparkContext
    every: dict[bytes, int] = {}
    for probes in groups:
        for word in probes.vocabulary:
            every.setdefault(word, len(every))
    located = _block_terms(rows, context.broadcast(every))
    seen, blocks = _count_terms(located, len(every))
    searches = []
    for probes in groups:
        terms = np.fromiter(map(every.__getitem__, probes.vocabulary), np.int64, len(probes.vocabulary))
        own = np.full(len(every) + 1, -1, np.int32)
        own[terms] = np.arange(len(terms))
        searches.append(_search(located, probes, own, seen[terms], blocks))
    shared = context.broadcast((every, searches))

    def find(texts: pa.Array) -> list[tuple[int, object, float, float, int]]:
        known, searches = shared.value
        out = []
        for row, chunk in chunks(texts, known):
            for search in searches:
                found = _matches(chunk.narrowed(search.own), search)
                out += [(row[text], item, *best) for (text, item), best in found.items()]
        return out

    return find


def _search(located: DataFrame, probes: Probes, own: np.ndarray, seen: np.ndarray, blocks: int) -> Search:
    context = located.sparkSession.sparkContext
    terms = len(seen)
    weight = context.broadcast(weights(probes, seen, blocks))
    together = _shared_passages(located, weight, context.broadcast(own))
    basis = np.random.default_rng(8).standard_normal((terms, min(terms, len(probes.ids) + OVERSAMPLING)))
    for _ in range(2):
        basis = np.linalg.qr(_product(together, weight, basis))[0]
    used = weight.value[weight.value > 0]
    outside = float(used.mean()) ** 2 if len(used) else 0.0
    return Search(own, probes, weight.value, outside, Latent(probes, weight.value, basis), Needles(probes, seen))


#: Ways that propose candidates, added up; and their names.
BY_LATENT, BY_WORDS = 1, 2
WAYS = {BY_LATENT: "latent", BY_WORDS: "words", BY_LATENT + BY_WORDS: "both"}


def _matches(chunk: Chunk, search: Search) -> dict:
    """Best cover, its cosine and the ways that proposed it by (text of the chunk, item)."""
    known, latent = search.probes, search.latent
    found: dict[tuple[int, object], tuple[float, float, int]] = {}
    masks: dict[int, dict[int, int]] = {}
    proposed: dict[tuple[int, int], int] = {}
    for way, places in ((BY_LATENT, latent.places(chunk)), (BY_WORDS, search.needles.places(chunk))):
        for place in places:
            proposed[place] = proposed.get(place, 0) + way
    for (b, probe), ways in proposed.items():
        text = int(np.searchsorted(chunk.first_block, b, side="right")) - 1
        first, end = chunk.starts[text], chunk.starts[text + 1]
        begin = first + (b - chunk.first_block[text]) * BLOCK
        low, high = begin - BLOCK, begin + 3 * BLOCK
        n = len(known.ids[probe])
        if probe not in masks:
            masks[probe] = _masks(known.ids[probe])
        cover = lcs(masks[probe], n, chunk.ids[max(low, first) : min(high, end)]) / n
        answer = known.answer[probe]
        if cover < (PARAPHRASE if answer and ways & BY_LATENT else COVER):
            continue
        if answer:
            after = chunk.ids[max(low, first) : min(high + PROBE + len(answer), end)]
            if lcs(_masks(answer), len(answer), after) < (ANSWER if cover >= COVER else 1) * len(answer):
                continue
        cosine = _cosine(chunk.ids[begin : min(begin + 2 * BLOCK, end)], latent.kernel[:, probe], search.outside, search.weight)
        case = text, known.item[probe]
        best = found.get(case, (0.0, 0.0, 0))
        found[case] = *max(best[:2], (cover, cosine)), best[2] | ways
    return found


def _cosine(passage: np.ndarray, kernel: np.ndarray, outside: float, weight) -> float:
    """Of a passage and an item; words outside the vocabulary are only in the norm."""
    term = np.unique(passage[passage >= 0])
    term = term[weight[term] > 0]
    square = (weight[term].astype(np.float64) ** 2).sum() + outside * np.count_nonzero(passage < 0)
    return float(kernel[term].sum() / np.sqrt(square)) if len(term) else 0.0


def _finders(docs: DataFrame, text: str, benchmark: DataFrame, item: str, item_text: str, group: int, groups: int):
    """A finder per ``groups`` groups of probes; the items are a stated set of queries, read group by group."""
    kind = "string" if benchmark.schema[item].dataType.simpleString() == "string" else "bigint"
    texts = docs.select(F.col(text).cast("string").alias("text"))
    items = benchmark.select(F.col(item).cast(kind).alias("item"), F.col(item_text).cast("string").alias("text"))
    every = (
        probe
        for row in items.orderBy("item", "text").toLocalIterator()
        for probe in Probes.split(row["item"], row["text"])
    )
    while held := list(islice(every, group * groups)):
        yield _finder(texts, [Probes(held[at : at + group]) for at in range(0, len(held), group)])


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    group: int = GROUP,
    groups: int = GROUPS,
) -> DataFrame:
    """``key``, ``item``, ``cover`` (share of the item's words in order), ``cosine`` and ``found_by`` of every leak."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    text_items = benchmark.schema[item].dataType.simpleString() == "string"
    item_type = pa.string() if text_items else pa.int64()
    kinds = (
        f"key {rows.schema['key'].dataType.simpleString()}, item {'string' if text_items else 'bigint'}, "
        "cover double, cosine double, ways int"
    )
    out = docs.sparkSession.createDataFrame([], kinds)
    for find in _finders(docs, text, benchmark, item, item_text, group, groups):

        def report(batches, find=find):
            for batch in batches:
                found = find(batch.column("text"))
                row, items, cover, cosine, ways = zip(*found, strict=True) if found else ((), (), (), (), ())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(row, pa.int64())),
                        pa.array(items, item_type),
                        pa.array(cover, pa.float64()),
                        pa.array(cosine, pa.float64()),
                        pa.array(ways, pa.int32()),
                    ],
                    names=["key", "item", "cover", "cosine", "ways"],
                )

        out = out.unionByName(rows.mapInArrow(report, kinds))
    names = F.create_map(*[F.lit(x) for way in WAYS.items() for x in way])
    return out.groupBy("key", "item").agg(
        F.max("cover").alias("cover"), F.max("cosine").alias("cosine"), names[F.bit_or("ways")].alias("found_by")
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    group: int = GROUP,
    groups: int = GROUPS,
) -> DataFrame:
    """The rows of ``docs`` that hold no item of ``benchmark``; they pass by once per ``groups`` groups, without a shuffle."""
    rows = docs.select(F.struct("*").alias("row"))
    at_text = docs.columns.index(text)
    for find in _finders(docs, text, benchmark, item, item_text, group, groups):

        def clean(batches, find=find):
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, *_ in find(batch.column("row").field(at_text)):
                    keep[row] = False
                yield batch.filter(pa.array(keep))

        rows = rows.mapInArrow(clean, rows.schema)
    return rows.select(*[F.col("row")[c].alias(c) for c in docs.columns])
