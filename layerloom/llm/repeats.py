"""Repeated passages across all documents, byte for byte.

Every byte covered by a string of ``LENGTH`` bytes that also starts elsewhere
(the same document included) is reported; strings never cross documents.

1. Anchors. In each window of ``LENGTH`` bytes the ``GRAM``-byte gram of least
   hash (the leftmost of equals) is its anchor: a choice made by the window's
   bytes alone, so equal windows have equal anchors at equal offsets. Hashing
   and minima run over a chunk of text at once; a long text is cut into chunks
   by window start, so no window is lost.
2. Grams that occur once are dropped. An anchor's context is what any window
   around it can hold; contexts that occur twice as a whole are repeats as a
   whole. What is left are the distinct contexts of one gram: the edges of
   passages.
3. Those form a bucket per gram. In a bucket an enhanced suffix array is built of
   the suffixes that can hold a window, aligned by their offset to the anchor
   (unaligned ones could match themselves through another anchor). Its common
   prefixes of ``LENGTH`` or more are scanned with a stack into the tree of
   common-prefix intervals; intervals whose occurrences differ in the byte before
   them are the maximal repeats, each with all its occurrences.
4. A bucket too large for one task is divided first. All windows that begin
   ``low`` to ``high`` bytes before the anchor hold the bytes from ``-low`` to
   ``LENGTH - high``, so a repeat among them only joins contexts that agree in that
   core: each core is a bucket of its own, and one still too large is divided by
   halves of its offsets. Contexts that agree in all that these windows reach, the
   hull, repeat there as a whole, and one of them goes on for all. So a passage that
   very many contexts share is settled whole, and only the halves that hold its edges
   are divided further. At one offset core and hull are the window itself, hence
   every bucket ends up small enough for the suffix array, or settled.

Windows around one anchor overlap, so what repeats of a context is one span, from
the first start to the last end of its repeats.

NULL texts count as empty, texts under ``LENGTH`` bytes have nothing removed. A
document is known by its key and text; rows equal in both are repeats of each
other. NULL keys work like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import content_md5, cut, leading_bits, scratch, stored, text_or_empty

LENGTH = 200
GRAM = 64
BEFORE = LENGTH - GRAM
CHUNK = 1 << 20
#: Contexts of a bucket that one task sorts; which buckets are divided changes no result.
BUCKET = 1024
#: Contexts whose suffixes are sorted together.
SORTED = 1024

_BYTE = np.random.default_rng(200).integers(1, 1 << 63, 256, dtype=np.uint64)
_MIX = np.random.default_rng(201).integers(1, 1 << 63, (8, 2), dtype=np.uint64) | np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)


def joined_hashes(data: np.ndarray, doublings: int) -> np.ndarray:
    """Hash of the ``2 ** doublings`` bytes from each position, by joining halves."""
    h, half = _BYTE[data], 1
    for first, second in _MIX[:doublings]:
        joined = h[:-half] * first
        joined += h[half:]
        joined *= second
        joined ^= joined >> np.uint64(31)
        h, half = joined, half * 2
    return h


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes from each position."""
    return joined_hashes(data, GRAM.bit_length() - 1)


def anchors(texts: list[bytes], chunk: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For chunks of ``texts``: index of each anchor's text, its place in that text, its hash; each anchor once."""
    last = (-1, -1)
    for index, place, gram in _all_anchors(texts, chunk or CHUNK):
        # places never fall within a text, so only the last one can be an anchor of the next chunk too
        new = (index != last[0]) | (place > last[1])
        if len(index):
            last = int(index[-1]), int(place[-1])
        yield index[new], place[new], gram[new]


def _all_anchors(texts: list[bytes], chunk: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - LENGTH + 1), chunk):
            piece = text[at : at + chunk + LENGTH - 1]
            held.append((i, at, piece))
            size += len(piece)
            if size >= chunk:
                yield _chunk_anchors(held)
                held, size = [], 0
    if held:
        yield _chunk_anchors(held)


def _chunk_anchors(held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(p) for _, _, p in held])
    starts = np.cumsum(lengths) - lengths
    hashes = gram_hashes(np.frombuffer(b"".join(p for _, _, p in held), np.uint8))
    least = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    span, width = 1, BEFORE + 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    inside = np.ones(len(least) + 1, np.int8)
    for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
        inside[start + length - LENGTH + 1 : start + length] = 0
    place = least[inside[: len(least)] > 0] & _PLACE
    place = np.unique(place).astype(np.int64)
    piece = np.searchsorted(starts, place, side="right") - 1
    index = np.array([i for i, _, _ in held])[piece]
    offset = np.array([at for _, at, _ in held])[piece]
    return index, place - starts[piece] + offset, hashes[place].view(np.int64)


def context_bounds(place, size):
    """Where the windows around an anchor can begin and end."""
    return np.maximum(place - BEFORE, 0), np.minimum(place + LENGTH, size)


def _anchor_rows(with_context: bool, chunk: int):
    def rows(batches):
        for batch in batches:
            texts = batch.column("data").to_pylist()
            sizes = np.array([len(t) for t in texts], np.int64)
            for index, place, gram in anchors(texts, chunk):
                columns = [pa.array(gram)]
                names = ["gram"]
                if with_context:
                    low, high = context_bounds(place, sizes[index])
                    digest = xxhash.xxh3_64_intdigest
                    context = np.fromiter(
                        (
                            digest(texts[i][a:b])
                            for i, a, b in zip(index.tolist(), low.tolist(), high.tolist(), strict=True)
                        ),
                        np.uint64,
                        len(index),
                    ).view(np.int64)
                    taken = pa.array(index)
                    columns += [
                        pa.array(context),
                        batch.column("key").take(taken),
                        batch.column("digest").take(taken),
                        pa.array(place.astype(np.int32)),
                    ]
                    names += ["context", "key", "digest", "place"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows


def maximal_repeats(
    bucket: np.ndarray, contexts: list[bytes], before: np.ndarray
) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """(length, occurrences) of the maximal repeats within each bucket.

    An occurrence is the index of a context and where in it the repeat starts.
    ``before`` is how many bytes of a context stand before its anchor.
    """
    sizes = np.array([len(c) for c in contexts])
    bases = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    half = joined_hashes(flat, 7)
    first, second = _MIX[7]
    whole = (half[: 128 - LENGTH] * first + half[LENGTH - 128 :]) * second

    starts_per = sizes - LENGTH + 1
    owner = np.repeat(np.arange(len(contexts)), starts_per)
    start = np.arange(len(owner)) - np.repeat(np.cumsum(starts_per) - starts_per, starts_per)
    place = bases[owner] + start
    # the byte before each suffix; none at a context's edge, which differs from every other
    previous = np.where(start > 0, flat[place - 1].astype(np.int64), -1 - np.arange(len(start)))

    # suffixes by bucket, offset to the anchor and first bytes: the roots of the interval tree
    aligned = (np.unique(bucket, return_inverse=True)[1][owner] << 9 | (before[owner] - start)).astype(np.uint64)
    root = (whole[place] ^ (aligned * second)) * first
    order = np.argsort(root, kind="stable")
    heads = np.flatnonzero(np.append(True, root[order][1:] != root[order][:-1]))
    counts = np.diff(np.append(heads, len(order)))
    # where one byte stands before all of them, the longer repeat has another offset
    differ = np.minimum.reduceat(previous[order], heads) != np.maximum.reduceat(previous[order], heads)
    use = np.repeat((counts > 1) & differ, counts)
    if not use.any():
        return
    order, group = order[use], np.repeat(np.arange(len(heads)), counts)[use]

    # suffix array and longest common prefixes within the roots that are left
    width = BEFORE + LENGTH
    room = np.minimum(sizes[owner[order]] - start[order], width)
    rows = np.zeros((len(order), width), np.uint8)
    at = np.arange(width)
    inside = at < room[:, None]
    rows[inside] = flat[(place[order][:, None] + at)[inside]]
    sort = np.lexsort((rows.view(f"S{width}")[:, 0], group))
    rows, room, group, order = rows[sort], room[sort], group[sort], order[sort]
    differs = rows[1:] != rows[:-1]
    lcp = np.where(differs.any(axis=1), differs.argmax(axis=1), width)
    lcp = np.minimum(lcp, np.minimum(room[1:], room[:-1]))
    lcp = np.append(0, np.where(group[1:] == group[:-1], lcp, 0)).tolist()
    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group)).tolist()
    turns = np.append(0, np.cumsum(np.diff(previous[order]) != 0)).tolist()
    owner, start = owner[order].tolist(), start[order].tolist()

    low = 0
    for high in ends:
        stack = [(LENGTH, low)]
        for i in range(low + 1, high + 1):
            common = lcp[i] if i < high else LENGTH - 1
            begin = i - 1
            while stack and stack[-1][0] > common:
                length, begin = stack.pop()
                if i - begin > 1 and turns[i - 1] != turns[begin]:
                    yield length, list(zip(owner[begin:i], start[begin:i], strict=True))
            if common >= LENGTH and (not stack or stack[-1][0] < common):
                stack.append((common, begin))
        low = high


def _whole_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole buckets, of ``SORTED`` rows or a little more; rows come sorted by gram."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < SORTED:
            continue
        table = pa.Table.from_batches(held)
        gram = table.column("gram").to_numpy()
        ends = np.flatnonzero(gram[1:] != gram[:-1]) + 1
        done = 0
        while table.num_rows - done >= SORTED:
            fitting = ends[(ends > done) & (ends <= done + SORTED)]
            later = ends[ends > done + SORTED]
            if not len(fitting) and not len(later):
                break
            end = int(fitting[-1] if len(fitting) else later[0])
            yield table.slice(done, end - done)
            done = end
        held = table.slice(done).to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _once(table: pa.Table) -> pa.Table:
    """Without rows of the same gram, document and place, which equal input rows bring."""
    first: dict = {}
    columns = (table.column(c).to_pylist() for c in ("gram", "key", "digest", "place"))
    for i, row in enumerate(zip(*columns, strict=True)):
        first.setdefault(row, i)
    return table if len(first) == table.num_rows else table.take(pa.array(list(first.values()), pa.int64()))


def _occurrences(batches):
    """Occurrences of the maximal repeats in the buckets of a sorted partition."""
    for table in _whole_buckets(batches):
        table = _once(table)
        if not table.num_rows:
            continue
        place, low = table.column("place").to_numpy(), table.column("begin").to_numpy()
        gram, contexts = table.column("gram").to_numpy(), table.column("bytes").to_pylist()
        found = [
            (n, i, int(low[i]) + at, length)
            for n, (length, where) in enumerate(maximal_repeats(gram, contexts, place - low))
            for i, at in where
        ]
        group, which, begin, length = np.array(found, np.int64).reshape(-1, 4).T
        rows = table.select(["key", "digest", "gram", "place"]).take(pa.array(which)).combine_chunks()
        yield pa.RecordBatch.from_arrays(
            [
                *(rows.column(c).combine_chunks() for c in ("key", "digest", "gram", "place")),
                pa.array(group.astype(np.int32)),
                pa.array(begin.astype(np.int32)),
                pa.array((begin + length).astype(np.int32)),
            ],
            names=["key", "digest", "gram", "place", "repeat", "low", "high"],
        )


def _edge_spans(batches):
    """What repeats of each context: from its first occurrence's start to its last one's end."""
    for batch in _occurrences(batches):
        spans = pa.Table.from_batches([batch]).group_by(["key", "digest", "place"])
        spans = spans.aggregate([("low", "min"), ("high", "max")]).combine_chunks()
        yield from spans.select(["key", "digest", "low_min", "high_max"]).rename_columns(
            ["key", "digest", "low", "high"]
        ).to_batches()


#: Of a context: its gram, document, anchor, first byte's place, and its bytes.
CONTEXT = ["gram", "key", "digest", "place", "begin", "bytes"]


def _cores(batches):
    """For a context and offsets ``low`` to ``high`` of windows: hashes of core and hull, and what windows are there.

    ``first`` and ``end`` bound the bytes that its windows reach, by place in the text.
    """
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        kept, cores, hulls, firsts, ends = [], [], [], [], []
        columns = (batch.column(c).to_pylist() for c in ("place", "begin", "bytes", "low", "high"))
        for i, (place, begin, text, low, high) in enumerate(zip(*columns, strict=True)):
            at = place - begin
            least, most = max(low, LENGTH - (len(text) - at)), min(high, at)
            if least > most:
                continue  # no window of these offsets fits
            hull = text[at - most : at + LENGTH - least]
            kept.append(i)
            cores.append(digest(text[at - low : at + LENGTH - high]))
            hulls.append(digest(hull, least << 8 | most))
            firsts.append(place - most)
            ends.append(place + LENGTH - least)
        held = batch.take(pa.array(kept, pa.int64()))
        hashes = [pa.array(np.array(h, np.uint64).view(np.int64)) for h in (cores, hulls)]
        places = [pa.array(p, pa.int32()) for p in (firsts, ends)]
        yield pa.RecordBatch.from_arrays(
            [*held.columns, *hashes, *places], names=[*held.schema.names, "core", "hull", "first", "end"]
        )


def _divide(contexts: DataFrame, bucket: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Spans of what large buckets' contexts share as a whole, and small buckets with the rest."""
    kinds = ", ".join(f"{c} {contexts.schema[c].dataType.simpleString()}" for c in CONTEXT)
    node = ["gram", "low", "high", "core"]
    open_ = contexts.select(*CONTEXT, F.lit(0).alias("low"), F.lit(BEFORE).alias("high"))
    spans, buckets = [], []
    while not open_.isEmpty():
        rows = open_.mapInArrow(_cores, f"{kinds}, low int, high int, core bigint, hull bigint, first int, end int")
        rows = stored(rows.withColumn("who", F.xxhash64("key", "digest", "place")), "cores")
        hulls = cut(rows.groupBy(*node, "hull").agg(F.min("who").alias("who"), F.max("who").alias("other")))
        again = hulls.where("who <> other").select(*node, "hull")
        spans.append(rows.join(again, [*node, "hull"]).select("key", "digest", F.col("first").alias("low"), F.col("end").alias("high")))
        mixed = cut(hulls.groupBy(*node).agg(F.count("*").alias("hulls")).where("hulls > 1"))
        # one context of each hull goes on, cut to what these windows reach
        one = rows.join(hulls.select(*node, "hull", "who"), [*node, "hull", "who"]).join(mixed, node)
        reach = F.substring("bytes", F.col("first") - F.col("begin") + 1, F.col("end") - F.col("first"))
        one = one.withColumns({"bytes": reach, "begin": F.col("first")})
        small = one.where(F.col("hulls") <= bucket)
        buckets.append(small.withColumn("gram", F.xxhash64(*node)).select(*CONTEXT))
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        halves = F.array(
            F.struct("low", middle.alias("high")), F.struct((middle + 1).alias("low"), F.col("high").alias("high"))
        )
        large = one.where((F.col("hulls") > bucket) & (F.col("low") < F.col("high")))
        open_ = stored(large.select(*CONTEXT, F.inline(halves)), "halves")
    return spans, buckets


def _contexts(batches):
    """Bytes of the contexts wanted from each text; a document's equal rows give them once a task."""
    given = set()
    for batch in batches:
        texts = _unpacked(batch)
        documents = list(zip(batch.column("key").to_pylist(), batch.column("digest").to_pylist(), strict=True))
        row, gram, place, begin, large, cutout = [], [], [], [], [], []
        for i, wanted in enumerate(batch.column("wanted").to_pylist()):
            if documents[i] in given:
                continue
            given.add(documents[i])
            for w in wanted:
                low, high = max(0, w["place"] - BEFORE), min(len(texts[i]), w["place"] + LENGTH)
                row.append(i)
                gram.append(w["gram"])
                place.append(w["place"])
                begin.append(low)
                large.append(w["large"])
                cutout.append(texts[i][low:high])
        taken = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(gram, pa.int64()),
                batch.column("key").take(taken),
                batch.column("digest").take(taken),
                pa.array(place, pa.int32()),
                pa.array(begin, pa.int32()),
                pa.array(large, pa.bool_()),
                pa.array(cutout, pa.binary()),
            ],
            names=["gram", "key", "digest", "place", "begin", "large", "bytes"],
        )


def _packed(batches):
    """Texts compressed, as they are shuffled."""
    codec = pa.Codec("zstd", compression_level=1)
    for batch in batches:
        texts = batch.column("data").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("digest"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary()),
            ],
            names=["key", "digest", "size", "packed"],
        )


def _unpacked(batch) -> list[bytes]:
    codec = pa.Codec("zstd")
    sizes, packed = batch.column("size").to_pylist(), batch.column("packed").to_pylist()
    return [codec.decompress(p, n, asbytes=True) if n else b"" for p, n in zip(packed, sizes, strict=True)]


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("key"),
        leading_bits(content_md5(key, text), 15).alias("digest"),
        text_or_empty(text).cast("binary").alias("data"),
    )


def _packed_documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = _documents(docs, key, text)
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_packed, f"key {kind}, digest bigint, size bigint, packed binary")


def repeated_spans(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", bucket: int = BUCKET, chunk: int | None = None
) -> DataFrame:
    """``key``, ``digest`` and byte spans [low, high) whose union is what repeats.

    Spans may overlap and may reach beyond the end of their text.
    """
    with scratch(docs.sparkSession):
        return cut(_spans(docs, key, text, bucket, chunk or CHUNK))  # read here, as tasks import the module afresh


def _spans(docs: DataFrame, key: str, text: str, bucket: int, chunk: int) -> DataFrame:
    rows = _documents(docs, key, text)
    kind = rows.schema["key"].dataType.simpleString()
    known = f"key {kind}, digest bigint"

    # written, so that the join below can split a frequent gram
    frequent = stored(
        rows.select("data")
        .mapInArrow(_anchor_rows(False, chunk), "gram bigint")
        .groupBy("gram")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("gram"),
        "grams",
    )
    kept = rows.mapInArrow(
        _anchor_rows(True, chunk), f"gram bigint, context bigint, {known}, place int"
    ).join(frequent, "gram")
    kept = stored(kept, "anchors")
    contexts = cut(
        kept.groupBy("gram", "context").agg(
            F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("key", "digest", "place")]
        )
    )
    whole = kept.join(contexts.where("n > 1").select("gram", "context"), ["gram", "context"]).select(
        "key",
        "digest",
        F.greatest(F.col("place") - BEFORE, F.lit(0)).alias("low"),
        (F.col("place") + LENGTH).alias("high"),
    )
    mixed = contexts.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1")
    wanted = (
        contexts.join(mixed, "gram")
        .groupBy("key", "digest")
        .agg(
            F.collect_list(
                F.struct("gram", "place", (F.col("members") > bucket).alias("large"))
            ).alias("wanted")
        )
        .select(F.col("key").alias("wanted_key"), F.col("digest").alias("wanted_digest"), "wanted")
    )
    same = (F.col("digest") == F.col("wanted_digest")) & F.col("key").eqNullSafe(F.col("wanted_key"))
    edges = stored(
        _packed_documents(docs, key, text)
        .join(wanted, same)
        .select("key", "digest", "size", "packed", "wanted")
        .mapInArrow(_contexts, f"gram bigint, {known}, place int, begin int, large boolean, bytes binary"),
        "contexts",
    )
    spans, buckets = _divide(edges.where("large"), bucket)
    small = reduce(DataFrame.unionByName, buckets, edges.where("not large").select(*CONTEXT))
    ordered = small.repartition("gram").sortWithinPartitions("gram")
    found = ordered.mapInArrow(_edge_spans, f"{known}, low int, high int")
    return reduce(DataFrame.unionByName, [whole, found, *spans])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [(a, b) for a, b in out]


def _kept(batches):
    for batch in batches:
        size, gone, runs, digests = [], [], [], []
        spans = zip(batch.column("lows").to_pylist(), batch.column("highs").to_pylist(), strict=True)
        for data, (lows, highs) in zip(_unpacked(batch), spans, strict=True):
            ends = [min(h, len(data)) for h in highs or []]
            cutout = merged(list(zip(lows or [], ends, strict=True)))
            left, at = hashlib.sha256(), 0
            for low, high in cutout:
                left.update(data[at:low])
                at = high
            left.update(data[at:])
            size.append(len(data))
            gone.append(sum(b - a for a, b in cutout))
            runs.append(len(cutout))
            digests.append(left.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                *[pa.array(v, pa.int64()) for v in (size, gone, runs)],
                pa.array(digests, pa.string()),
            ],
            names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _by_document(spans: DataFrame) -> DataFrame:
    """The distinct spans of each document; equal rows of it add nothing, in a task or across them."""
    return (
        spans.groupBy("key", "digest")
        .agg(F.collect_set(F.struct("low", "high")).alias("spans"))
        .select(
            F.col("key").alias("span_key"),
            F.col("digest").alias("span_digest"),
            F.col("spans.low").alias("lows"),
            F.col("spans.high").alias("highs"),
        )
    )


def without_repeats(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", bucket: int = BUCKET, chunk: int | None = None
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` of every row."""
    spans = _by_document(repeated_spans(docs, key=key, text=text, bucket=bucket, chunk=chunk))
    rows = _packed_documents(docs, key, text)
    same = (F.col("digest") == F.col("span_digest")) & F.col("key").eqNullSafe(F.col("span_key"))
    kind = rows.schema["key"].dataType.simpleString()
    return (
        rows.join(spans, same, "left")
        .select("key", "size", "packed", "lows", "highs")
        .mapInArrow(_kept, f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    )
