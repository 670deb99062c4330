"""Near-duplicates by SimHash, found with BK-trees.

A fingerprint has 64 bits, each set where over half of the text's word shingles
have it set in their XXH64. Fingerprints within three bits agree in at least two
of five bit blocks, so each is put in ten shards, one per pair of blocks and its
bits. Each shard with two or more fingerprints becomes BK-trees (children keyed
by their integer distance to the parent, searches follow only edges within the
radius of the distance met). A shard of more than ``TREE_NODES`` fingerprints
becomes several trees and every pair of its parts is searched in a unit of its
own, so no task holds more than two parts. A unit reports a spanning forest of
the links it found: as many as it has fingerprints, not as many as it has pairs.
The trees go to the tasks that hold their shard's searches, as together they
grow with the corpus and have no bound for a broadcast.

Copies of a fingerprint are one node. A text without words has fingerprint zero.
NULL texts count as empty; NULL keys are passed over when a component is named.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import cut, text_or_empty
from layerloom.llm.components import connected_components

SHINGLE_WORDS = 3
RADIUS = 3
#: Lowest bit and width of each block.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
TREE_NODES = 4096
#: Shingles whose bits are counted at once.
COUNTED = 50_000


def fingerprint(text: str) -> int:
    """Of lower-cased ASCII letters, words between ASCII white space and three-word shingles."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: 1 - SHINGLE_WORDS].tolist()
    ends = ends[SHINGLE_WORDS - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], 42) for s, e in zip(starts, ends, strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNTED):
        part = np.array(hashes[at : at + COUNTED], np.uint64)
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches):
    for batch in batches:
        values = np.fromiter(
            (fingerprint(t.as_py()) for t in batch.column("text")), np.uint64, batch.num_rows
        ).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(values)],
            names=[*batch.schema.names[:-1], "fingerprint"],
        )


def fingerprints(docs: DataFrame, *, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` (columns of ``docs``) and ``fingerprint`` (the 64 bits as a long) of every row."""
    rows = docs.select(*keys, text_or_empty(text).alias("text"))
    kinds = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    return rows.mapInArrow(_fingerprints, ", ".join([*kinds, "fingerprint bigint"]))


class BKTree:
    """Nodes and, for each, its children by distance; built from the root down."""

    def __init__(self, values: np.ndarray):
        self.nodes: list[np.uint64] = []
        self.children: list[dict[int, int]] = []
        waiting = [(np.unique(values), -1, 0)]
        while waiting:
            group, parent, edge = waiting.pop()
            node = len(self.nodes)
            self.nodes.append(group[0])
            self.children.append({})
            if parent >= 0:
                self.children[parent][edge] = node
            rest = group[1:]
            if len(rest):
                far = np.bitwise_count(rest ^ group[0])
                for d in np.unique(far).tolist():
                    waiting.append((rest[far == d], node, d))

    def search(self, queries: np.ndarray, radius: int = RADIUS):
        """(node value, indices of the queries within the radius of it), for every node with any."""
        waiting = [(0, np.arange(len(queries)))]
        while waiting:
            node, active = waiting.pop()
            far = np.bitwise_count(queries[active] ^ self.nodes[node]).astype(np.int16)
            found = active[far <= radius]
            if len(found):
                yield self.nodes[node], found
            for edge, child in self.children[node].items():
                follow = active[np.abs(far - edge) <= radius]
                if len(follow):
                    waiting.append((child, follow))


def _forest(tree: np.ndarray, queries: np.ndarray) -> list[tuple[int, int]]:
    """Links between ``tree`` and ``queries`` that span what all of them connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    out = []
    for value, found in BKTree(tree).search(queries):
        a = int(value)
        for b in queries[found].tolist():
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                out.append((a, b))
    return out


def _units(batches):
    """Consecutive rows of one unit (shard, i, j); a unit is at most two parts long."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        marks = np.stack([table.column(c).to_numpy() for c in ("shard", "i", "j")])
        starts = np.flatnonzero(np.any(marks[:, 1:] != marks[:, :-1], axis=0)) + 1
        if len(starts):
            done = table.slice(0, starts[-1])
            held = table.slice(starts[-1]).to_batches()
            yield done, np.concatenate([[0], starts])
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.array([0, table.num_rows])


def _links(batches):
    for table, bounds in _units(batches):
        values = table.column("fingerprint").to_numpy().view(np.uint64)
        part, i, j = (table.column(c).to_numpy() for c in ("part", "i", "j"))
        if bounds[-1] != table.num_rows:
            bounds = np.append(bounds, table.num_rows)
        out = []
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            of_tree = part[s:e] == i[s]
            tree = values[s:e][of_tree]
            queries = tree if i[s] == j[s] else values[s:e][~of_tree]
            if len(tree) and len(queries):
                out += _forest(tree, queries)
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def links(values: DataFrame, tree_nodes: int = TREE_NODES) -> DataFrame:
    """Links (a, b) that connect whatever distinct ``fingerprint`` values within the radius connect."""
    shards = []
    for n, (p, q) in enumerate(combinations(BLOCKS, 2)):
        bits = [F.shiftrightunsigned("fingerprint", low).bitwiseAND((1 << width) - 1) for low, width in (p, q)]
        shards.append((F.shiftleft(bits[0], 13) + bits[1]) * F.lit(16) + F.lit(n))
    spread = values.select("fingerprint", F.explode(F.array(*shards)).alias("shard"))
    parts = (
        spread.groupBy("shard")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("shard", F.ceil(F.col("n") / tree_nodes).cast("int").alias("parts"))
    )
    placed = spread.join(parts, "shard").withColumn("part", F.expr("cast(pmod(xxhash64(fingerprint), parts) as int)"))
    units = placed.select(
        "shard",
        "fingerprint",
        "part",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"),
    ).select(
        "shard", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "fingerprint"
    )
    sorted_units = units.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j")
    return sorted_units.mapInArrow(_links, "a bigint, b bigint")


def label(found: DataFrame, key: str, tree_nodes: int = TREE_NODES) -> DataFrame:
    """``fingerprint`` and ``component``: the least ``key`` among all rows it is linked to."""
    values = cut(found.groupBy("fingerprint").agg(F.min(key).alias("least")))
    roots = connected_components(links(values, tree_nodes))
    rooted = values.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return rooted.select("fingerprint", "root").join(named, "root").select("fingerprint", "component")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    found = cut(fingerprints(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), keys=["key"]))
    return found.join(label(found, "key"), "fingerprint").select(
        "key",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component: that of the least key (NULL last), then of the least text hash."""
    rows = docs.select(
        F.struct("*").alias("row"), F.col(key).alias("key"), F.md5(text_or_empty(text)).alias("digest")
    )
    plain = docs.select(F.col(key).alias("key"), F.md5(text_or_empty(text)).alias("digest"), F.col(text).alias("text"))
    rank = F.struct(F.col("key").isNull().alias("unkeyed"), F.col("key").alias("key"), F.col("digest").alias("digest"))
    found = cut(fingerprints(plain, keys=["key", "digest"]).withColumn("rank", rank))
    kept = (
        found.join(label(found, "rank"), "fingerprint")
        .where("rank = component")
        .groupBy("key", "digest")
        .agg(F.count("*").alias("copies"))
    )
    kept = cut(kept.select(F.col("key").alias("kept_key"), F.col("digest").alias("kept_digest"), "copies"))
    left = rows.join(
        kept, (F.col("digest") == F.col("kept_digest")) & F.col("key").eqNullSafe(F.col("kept_key"))
    ).select("row", "key", "digest", "copies")
    if not kept.where("copies > 1").isEmpty():
        left = left.dropDuplicates(["key", "digest"])
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])
