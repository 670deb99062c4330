"""The prefix trie against a plain one over all prefixes, and the scan at many borders."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from layerloom.llm import prefix_trie
from layerloom.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place string, path string, skeleton string, kind string"


def rebuilt_of(rows):
    """Rebuilt (role, text) turns of every conversation, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0, role or ""), (role or "", text or "")))
    own = {c: [t for _, t in sorted(turns, key=lambda x: x[0])] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) if children[node] else 1
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own + sum(saved[c] for c in children[node])
    out = []
    for node, of in members.items():
        ends = sorted(c for c in of if len(convs[c]) == len(node))
        out.append((
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children[node]),
            leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r[c] for c in prefix_trie.COLUMNS) for r in df.collect()), key=str)


def trie(spark, rows):
    table = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)
    turns = prefix_trie.numbered_turns(table)
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns), slack=prefix_trie.BORROWED)


def test_query_against_brute_force(spark, sf_dir):
    for folder in {sf_dir, sf_dir.replace("0.001", "0.01")}:
        rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
        want = plain_trie(rebuilt_of([tuple(r) for r in rows]))
        assert rows_of(QUERIES["op11_prefix_trie"](spark, folder)) == want


@pytest.mark.parametrize("first_turns", [2, 64])
def test_copies_over_many_shards(spark, monkeypatch, first_turns):
    """Few distinct turns, a third of all conversations alike, shared beginnings beyond the first cut."""
    monkeypatch.setattr(prefix_trie, "FIRST_TURNS", first_turns)
    rng = random.Random(5)
    rows = []
    for c in range(300):
        n = 3 if c % 3 == 0 else rng.randint(1, 9)
        for t in range(n):
            rows.append((c, t, "user", "same" if c % 3 == 0 else rng.choice("ab") * 3))
    rng.shuffle(rows)
    assert rows_of(trie(spark, rows)) == plain_trie(rebuilt_of(rows))


def test_one_conversation_with_a_third_of_all_turns(spark):
    rows = [(7, t, "user", f"turn {t % 50}") for t in range(9000)]
    rows += [(c, t, "user", f"turn {t}") for c in range(200, 6200) for t in range(3)]
    out = trie(spark, rows)
    own = out.where("conv_id = 7").agg(F.max("depth"), F.sum("n_leaves"), F.count("*")).first()
    assert rows_of(out) == plain_trie(rebuilt_of(rows)) and own[0] == len(rebuilt_of(rows)[7])


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost"),
        (0, None, None, "null turn first"), (0, 0, "user", None), (0, 1, "user", ""), (0, 1, "user", ""),
        (1, 5, "user", "é😀x"), (1, None, None, None),
        (2, 0, "user", "only"),
        (-5, 0, "user", "negative"), (-5, 1, "user", "more"), (-105, 0, "a", "b"),
        (350, 0, "user", "no base"), (351, 0, "user", "no base"), (352, 0, "user", "x" * 300_000),
        (8, 1, "b", "tie"), (8, 1, "a", "tie"), (8, 0, "system", "first"),
    ]
    assert rows_of(trie(spark, rows)) == plain_trie(rebuilt_of(rows))
    assert trie(spark, []).count() == 0
    only_null = trie(spark, [(None, 1, "user", "x")])
    assert only_null.count() == 0


def test_skeleton_at_every_border():
    """One scan a shard, for all numbers of shards: partial sums add up to the same trie."""
    rng = random.Random(1)
    convs = {c: [("u", rng.choice("ab")) for _ in range(rng.randint(0, 6))] for c in range(40)}
    step = {t: hashlib.sha256(repr(t).encode()).digest()[: prefix_trie.STEP] for turns in convs.values() for t in turns}
    paths = sorted((b"".join(step[t] for t in turns), c) for c, turns in convs.items())
    for width in (1, 2, 3, 7, 40):
        shards = [paths[i : i + width] for i in range(0, len(paths), width)]
        skeleton, sizes = {b"": 0}, [0]
        for one, two in zip(shards, shards[1:]):
            for d in range(1, prefix_trie.shared_steps(one[-1][0], two[0][0]) + 1):
                if two[0][0][: d * prefix_trie.STEP] not in skeleton:
                    skeleton[two[0][0][: d * prefix_trie.STEP]] = len(skeleton)
                    sizes.append(1)
        nodes, tails, partial = [], 0, defaultdict(lambda: [0, 0, 0, 0, None])
        for n, shard in enumerate(shards):
            scan = prefix_trie.Scan(skeleton, n)
            for (path, c), following in zip(shard, [*shard[1:], (None, None)]):
                scan.add(c, path, [1] * (len(path) // prefix_trie.STEP), len(path) // prefix_trie.STEP, following[0])
            scan.finish()
            for row in scan.out:
                if row[0] == prefix_trie.NODE:
                    nodes.append((row[1], row[2], *row[7:11]))
                elif row[0] == prefix_trie.OWN:
                    nodes += [(row[1], d, 1, int(d < row[3]), 1, 0) for d in range(row[2] + 1, row[3] + 1)]
                elif row[0] == prefix_trie.PARTIAL:
                    sums = partial[row[6]]
                    for i in range(4):
                        sums[i] += row[7 + i]
                    sums[4] = row[1] if sums[4] is None else min(sums[4], row[1])
        names = ("n_convs", "n_children", "n_leaves", "saved", "least")
        rows = [{"skeleton": i, **dict(zip(names, v))} for i, v in partial.items()]
        folded = prefix_trie._folded([type("R", (dict,), {"asDict": lambda s: dict(s)})(r) for r in rows], skeleton, sizes)
        nodes += [(r[1], r[2], *r[4:]) for r in folded]
        assert sorted(nodes) == sorted((r[0], r[1], *r[3:7]) for r in plain_trie(convs)), width
