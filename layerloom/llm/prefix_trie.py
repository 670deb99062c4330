"""The trie of conversations' prefixes by splitters and their skeleton.

A conversation is the path of its turns' digests (128 bits of SHA-256 of role and
text), a node is a distinct prefix of paths, and its members are the conversations
that start with it. Paths are sorted over range partitions, shards, with the
conversation's id last, so that equal paths may part too. A node whose members lie
in several shards is a prefix of the path at a splitter, the border between two
shards. The trie of those prefixes, the skeleton, is broadcast: as many paths as
there are borders. Each shard scans its paths with a stack of the open prefixes
and finishes every other node; for skeleton nodes it gives partial sums, which are
reduced over the shards and then folded up the skeleton.

Paths are cut where nothing beyond can be shared: they start with ``FIRST_TURNS``
turns, and only conversations that have more turns and still share all of these
with another go on, with twice as many. A row thus holds at most twice what a
conversation shares, however many turns it has; the nodes beyond, which are its
own alone, are counted out from its length. Turns are numbered by a sort over all
of them, so a conversation with very many parts over tasks.

Turns are ordered by ``turn`` (NULL first), equal ones by role and then by digest.
NULL roles and texts are empty, rows without a conversation take no part, and
repeated rows are turns of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import cut

FIRST_TURNS = 64
#: Conversations whose ids share all but their last digits, and turns that are not borrowed from their first.
FAMILY, BORROWED = 100, 6
#: Bytes of a turn's digest.
STEP = 16
#: Conversation ids that go to a skeleton node's hash in one row.
CHUNK = 2000
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

TURNS = "conv_id bigint, digest binary, size bigint, part int, first boolean, place bigint"


def _turn_digest(role: Column, text: Column) -> Column:
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * STEP))


def numbered_turns(
    conversations: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``digest`` and ``size`` (code points) of every turn."""
    given = conversations.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = given.select(
        "conv_id",
        "turn",
        "role",
        _turn_digest(F.col("role"), F.col("text")).alias("digest"),
        F.length("text").cast("bigint").alias("size"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "digest"]

    def number(batches):
        part, last, place, lead = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            places, first = [], []
            for conv in batch.column("conv_id").to_pylist():
                lead = lead and (last is None or conv == last)
                place = place + 1 if conv == last else 1
                last = conv
                places.append(place)
                first.append(lead)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("conv_id", "digest", "size")),
                    pa.array([part] * batch.num_rows, pa.int32()),
                    pa.array(first, pa.bool_()),
                    pa.array(places, pa.int64()),
                ],
                names=["conv_id", "digest", "size", "part", "first", "place"],
            )

    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "digest", "size")
    found = cut(ordered.mapInArrow(number, TURNS))
    # a conversation over several partitions is the first of all but one of them
    ends = found.groupBy("part").agg(
        F.min("conv_id").alias("low"), F.max("conv_id").alias("high"),
        F.max_by("place", F.struct("conv_id", "place")).alias("turns"),
    )
    before, carried, held = None, [], 0
    for row in sorted(ends.collect(), key=lambda r: r["part"]):  # a row per partition
        held = held if before == row["low"] else 0
        carried.append((row["part"], held))
        held = row["turns"] + (held if row["low"] == row["high"] else 0)
        before = row["high"]
    carry = found.sparkSession.createDataFrame(carried, "part int, carried bigint")
    place = F.col("place") + F.when(F.col("first"), F.col("carried")).otherwise(0)
    return found.join(F.broadcast(carry), "part").select("conv_id", place.alias("place"), "digest", "size")


def rebuilt(turns: DataFrame, family: int = FAMILY, borrowed: int = BORROWED) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their ``family`` ids does: turns and, per conversation, ``n_turns``.

    The first h turns come from conversation c - c % family (all if fewer, none if
    absent), with h the CRC-32 of the id's decimal text modulo ``borrowed``; then
    the conversation's own turns after its first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % borrowed).alias("h")
    own = turns.groupBy("conv_id").agg(F.max("place").alias("own")).select("*", h)
    own = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    lent = turns.where((F.col("conv_id") % family == 0) & (F.col("place") < borrowed)).withColumnRenamed("conv_id", "base")
    lengths = lent.groupBy("base").agg(F.max("place").alias("lent"))
    sizes = own.join(lengths, "base", "left").select(
        "conv_id",
        (F.least("h", F.coalesce("lent", F.lit(0))) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"),
    )
    taken = own.join(lent, "base").where("place <= h").select("conv_id", "place", "digest", "size")
    kept = turns.select("*", h).where("place > h")
    kept = kept.select("conv_id", F.col("place") + borrowed - F.col("h"), "digest", "size")
    return taken.union(kept), sizes


def _paths(turns: DataFrame, sizes: DataFrame, slack: int) -> DataFrame:
    """``path``, ``lengths`` (of its texts), ``n_turns`` of every conversation, as far as it shares turns."""
    limit, open_, near, done = FIRST_TURNS, sizes, turns, []
    while True:
        heads = near.where(F.col("place") <= limit + slack).groupBy("conv_id")
        heads = heads.agg(F.sort_array(F.collect_list(F.struct("place", F.hex("digest").alias("hex"), "size"))).alias("held"))
        held = F.slice("held", 1, limit)
        found = cut(
            open_.join(heads, "conv_id", "left").select(
                "conv_id",
                "n_turns",
                F.coalesce(F.unhex(F.array_join(held["hex"], "")), F.lit(b"")).alias("path"),
                F.coalesce(held["size"], F.array().cast("array<bigint>")).alias("lengths"),
            )
        )
        shared = found.where(F.length("path") == limit * STEP).groupBy("path").count().where("count > 1").select("path")
        open_ = cut(found.where(F.col("n_turns") > limit).join(shared, "path", "left_semi").select("conv_id", "n_turns"))
        if open_.isEmpty():
            return reduce(DataFrame.union, [*done, found])
        done.append(found.join(open_, "conv_id", "left_anti"))
        near = turns.join(open_, "conv_id", "left_semi")
        limit *= 2


def shared_steps(one: bytes, two: bytes) -> int:
    """How many leading turns two paths share."""
    low, high = 0, min(len(one), len(two)) // STEP
    if one[: high * STEP] == two[: high * STEP]:
        return high
    while high - low > 1:
        middle = (low + high) // 2
        if one[low * STEP : middle * STEP] == two[low * STEP : middle * STEP]:
            low = middle
        else:
            high = middle
    return low


@dataclass
class Node:
    """An open prefix while its members go by."""

    skeleton: int | None
    size: int
    least: int | None = None
    members: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: hashlib._Hash | None = None
    ended: list[str] = field(default_factory=list)
    chunk: int = 0
    #: Rows whose parent this is; they wait for its least member.
    waiting: list[tuple] = field(default_factory=list)


KINDS = (
    "kind int, conv_id bigint, depth bigint, last bigint, parent bigint, above int, skeleton int, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved bigint, ends string, shard int, chunk bigint"
)
#: Rows of a scan: a finished node, a conversation's own nodes, a skeleton node's sums, some of its ends.
NODE, OWN, PARTIAL, ENDS = range(4)


class Scan:
    """Paths of one shard in order, with the stack of their open prefixes."""

    def __init__(self, skeleton: dict[bytes, int], shard: int):
        self.skeleton, self.shard = skeleton, shard
        self.stack = [Node(skeleton[b""], 0)]
        self.path = b""
        self.out: list[tuple] = []

    def _give(self, parent: Node, row: tuple) -> None:
        """Give a row out, or let it wait until its parent's least member is known."""
        if parent.skeleton is None:
            parent.waiting.append(row)
        else:
            self.out.append((*row[:4], None, parent.skeleton, *row[4:]))

    def _flush(self, node: Node) -> None:
        if node.ended:
            text = ",".join(node.ended) + ","
            self.out.append((ENDS, None, None, None, None, None, node.skeleton, *[None] * 4, text, self.shard, node.chunk))
            node.ended, node.chunk = [], node.chunk + 1

    def _close(self, down_to: int) -> None:
        while len(self.stack) > down_to:
            node, depth = self.stack.pop(), len(self.stack)
            if node.skeleton is None:
                if not node.children:
                    node.leaves = 1
                node.saved += (node.members - 1) * node.size
            for row in node.waiting:
                self.out.append((*row[:4], node.least, None, *row[4:]))
            parent = self.stack[-1] if self.stack else None
            if node.skeleton is not None:
                self._flush(node)
                sums = (node.members, node.children, node.leaves, node.saved)
                self.out.append((PARTIAL, node.least, depth, None, None, None, node.skeleton, *sums, None, None, None))
            else:
                ends = node.ends.hexdigest() if node.ends else EMPTY_SHA256
                sums = (node.members, node.children, node.leaves, node.saved)
                self._give(parent, (NODE, node.least, depth, None, None, *sums, ends, None, None))
                parent.children += 1
            if parent:
                if node.members:
                    parent.least = node.least if parent.least is None else min(parent.least, node.least)
                parent.members += node.members
                parent.leaves += node.leaves
                parent.saved += node.saved

    def add(self, conv: int, path: bytes, sizes: list[int], n_turns: int, following: bytes | None) -> None:
        """The next path; ``following`` is the one after it, None at the shard's end."""
        stack, skeleton = self.stack, self.skeleton
        depth = shared_steps(self.path, path)
        self._close(depth + 1)
        depth = max(depth, shared_steps(path, following) if following is not None else 0)
        while len(stack) * STEP <= len(path):
            at = skeleton.get(path[: len(stack) * STEP]) if stack[-1].skeleton is not None else None
            if len(stack) > depth and at is None:
                break
            stack.append(Node(at, sizes[len(stack) - 1]))
        self.path, top, depth = path, stack[-1], len(stack) - 1
        top.least = conv if top.least is None else min(top.least, conv)
        top.members += 1
        if n_turns > depth:
            top.children += 1
            top.leaves += 1
            self._give(top, (OWN, conv, depth, n_turns, None, *[None] * 7))
        elif top.skeleton is None:
            top.ends = hashlib.sha256() if top.ends is None else (top.ends.update(b","), top.ends)[1]
            top.ends.update(str(conv).encode())
        else:
            top.ended.append(str(conv))
            if len(top.ended) == CHUNK:
                self._flush(top)

    def finish(self) -> None:
        self._close(0)


def _scanned(shared):
    def scan(batches):
        state, held = None, None

        def out():
            columns = list(zip(*state.out)) or [()] * len(SCHEMA)
            state.out = []
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, SCHEMA.types)], schema=SCHEMA)

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = zip(*(part.column(c).to_pylist() for c in ("conv_id", "path", "lengths", "n_turns")))
                for row in rows:
                    state = state or Scan(shared.value, TaskContext.get().partitionId())
                    if held:
                        state.add(*held, row[1])
                    held = row
                yield out()
        if held:
            state.add(*held, None)
            state.finish()
            yield out()

    return scan


_ARROW = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
SCHEMA = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in KINDS.split(", "))])


def _skeleton_of(paths: DataFrame) -> tuple[dict[bytes, int], list[int]]:
    """Every prefix that the last path of a shard shares with the first of the next, and the root; sizes of their last texts."""
    rank = F.struct("path", "conv_id", "lengths")
    ends = paths.groupBy(F.spark_partition_id().alias("shard")).agg(F.min(rank).alias("low"), F.max(rank).alias("high"))
    found, sizes, before = {b"": 0}, [0], b""
    for row in sorted(ends.collect(), key=lambda r: r["shard"]):  # a row per shard
        first = bytes(row["low"]["path"])
        for depth in range(1, shared_steps(before, first) + 1):
            if first[: depth * STEP] not in found:
                found[first[: depth * STEP]] = len(found)
                sizes.append(row["low"]["lengths"][depth - 1])
        before = bytes(row["high"]["path"])
    return found, sizes


def _hash_ends(batches):
    """SHA-256 of each skeleton node's ends, row by row in their order."""
    node, digest, last = None, None, ""
    for batch in batches:
        done = []
        for skeleton, ends in zip(batch.column("skeleton").to_pylist(), batch.column("ends").to_pylist()):
            if skeleton != node:
                if node is not None:
                    digest.update(last[:-1].encode())
                    done.append((node, digest.hexdigest()))
                node, digest, last = skeleton, hashlib.sha256(), ""
            digest.update(last.encode())
            last = ends
        if done:
            yield pa.RecordBatch.from_pydict({"skeleton": pa.array([d[0] for d in done], pa.int32()), "ends_sha256": [d[1] for d in done]})
    if node is not None:
        digest.update(last[:-1].encode())
        yield pa.RecordBatch.from_pydict({"skeleton": pa.array([node], pa.int32()), "ends_sha256": [digest.hexdigest()]})


def _folded(sums: list, skeleton: dict[bytes, int], sizes: list[int]) -> list[tuple]:
    """Rows of the skeleton's nodes from their sums over the shards, deepest first."""
    paths = {i: p for p, i in skeleton.items()}
    rows = {r["skeleton"]: r.asDict() for r in sums}
    order = sorted(rows, key=lambda i: -len(paths[i]))
    for i in order:
        if paths[i]:
            rows[skeleton[paths[i][:-STEP]]]["n_children"] += 1
    more = dict.fromkeys(rows, (0, 0))
    for i in order:
        leaf = int(not rows[i]["n_children"])
        saved = (rows[i]["n_convs"] - 1) * sizes[i]
        below = more[i]
        more[i] = below[0] + leaf, below[1] + saved
        if paths[i]:
            parent = skeleton[paths[i][:-STEP]]
            more[parent] = more[parent][0] + more[i][0], more[parent][1] + more[i][1]
    out = []
    for i in order:
        r, parent = rows[i], rows[skeleton[paths[i][:-STEP]]]["least"] if paths[i] else None
        out.append(
            (i, r["least"], len(paths[i]) // STEP, parent, r["n_convs"], r["n_children"],
             r["n_leaves"] + more[i][0], r["saved"] + more[i][1])
        )
    return out


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def prefix_trie(turns: DataFrame, sizes: DataFrame, *, slack: int = 0) -> DataFrame:
    """A row (``COLUMNS``) for each distinct prefix of ``turns`` (conv_id, place, digest, size), the empty one too.

    ``sizes`` has ``conv_id`` and ``n_turns`` of every conversation, also of those
    without turns. ``place`` orders a conversation's turns and is at most ``slack``
    more than a turn's number.
    """
    spark = turns.sparkSession
    order = ["path", "conv_id"]
    paths = cut(_paths(cut(turns), sizes, slack).repartitionByRange(*order).sortWithinPartitions(*order))
    skeleton, lengths = _skeleton_of(paths)
    shared = spark.sparkContext.broadcast(skeleton)
    kept = paths.select("conv_id", "path", "lengths", "n_turns")
    found = cut(kept.mapInArrow(_scanned(shared), KINDS))

    partial = found.where(F.col("kind") == PARTIAL).groupBy("skeleton").agg(
        F.min("conv_id").alias("least"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
    )
    sums = partial.collect()  # as many rows as the broadcast skeleton has nodes
    rows = _folded(sums, skeleton, lengths)
    kinds = "skeleton int, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
    upper = F.broadcast(spark.createDataFrame(rows, kinds))
    ends = found.where(F.col("kind") == ENDS).select("skeleton", "shard", "chunk", "ends")
    ends = ends.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "chunk").select("skeleton", "ends")
    hashed = ends.mapInArrow(_hash_ends, "skeleton int, ends_sha256 string")
    none = F.lit(EMPTY_SHA256)
    tops = upper.join(hashed, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))

    above = upper.select(F.col("skeleton").alias("above"), F.col("conv_id").alias("above_conv"))
    below = found.where(F.col("kind").isin(NODE, OWN)).join(above, "above", "left")
    below = below.withColumn("parent_conv_id", F.coalesce("parent", "above_conv"))
    nodes = below.where(F.col("kind") == NODE)
    nodes = nodes.withColumnsRenamed({"saved": "saved_tokens", "ends": "ends_sha256"})
    # a conversation's own nodes, some thousands of depths at a time
    runs = below.where(F.col("kind") == OWN).select(
        "conv_id", "parent_conv_id", "last", (F.col("depth") + 1).alias("top"),
        F.explode(F.sequence(F.col("depth") + 1, F.col("last"), F.lit(4096).cast("bigint"))).alias("at"),
    )
    runs = runs.withColumn("depth", F.explode(F.sequence("at", F.least(F.col("at") + 4095, F.col("last")))))
    is_last = F.col("depth") == F.col("last")
    one = F.lit(1).cast("bigint")
    tails = runs.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") == F.col("top"), F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(is_last, 0).otherwise(1).cast("bigint").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("bigint").alias("saved_tokens"),
        F.when(is_last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none).alias("ends_sha256"),
    )
    return tops.select(*COLUMNS).union(nodes.select(*COLUMNS)).union(tails.select(*COLUMNS))

