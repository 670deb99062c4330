"""SimHash components, BK-trees and connected components against brute force."""

import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerloom.llm import simhash
from layerloom.llm.components import connected_components
from layerloom.llm.queries import QUERIES


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(pairs, linked):
    parent = list(range(len(pairs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(pairs)):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(pairs))]


@given(st.text(alphabet="aB ç\n\t\x0b\x0c\x1f😀", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=12), st.lists(st.integers(0, 63), max_size=60))
def test_tree_finds_every_neighbour(values, flips):
    near = [v ^ (1 << f) ^ (1 << (f * 7 % 64)) for v, f in zip(values * 8, flips)]
    tree, queries = np.array(values + near, np.uint64), np.array(near + values, np.uint64)
    found = {(int(a), int(b)) for a, at in simhash.BKTree(tree).search(queries) for b in queries[at]}
    assert found == {(a, b) for a in tree.tolist() for b in queries.tolist() if (a ^ b).bit_count() <= simhash.RADIUS}


def test_components_of_odd_rows(make_docs, odd_pairs):
    got = simhash.near_duplicates(make_docs(odd_pairs)).collect()
    prints = [plain_fingerprint(t) for _, t in odd_pairs]
    roots = components_of(odd_pairs, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {}
    for (key, _), r in zip(odd_pairs, roots):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    want = sorted((str(k), f"{p:016x}", least.get(r)) for (k, _), p, r in zip(odd_pairs, prints, roots))
    assert sorted((str(r["key"]), r["fingerprint"], r["component_id"]) for r in got) == want


def test_one_row_of_each_group_stays(make_docs, odd_pairs):
    docs = make_docs(odd_pairs)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) == len(groups)
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("tree_nodes", [5, 4096])
def test_chains_of_links(spark, tree_nodes):
    """Long chains, each step within the radius, and shards over several trees."""
    rng = np.random.default_rng(3)
    values = []
    for _ in range(4):
        at = int(rng.integers(0, 2**63))
        for _ in range(40):
            values.append(at - (1 << 64) if at >= 1 << 63 else at)
            for b in rng.choice(64, 3, replace=False):
                at ^= 1 << int(b)
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    out = {r["node"]: r["root"] for r in connected_components(simhash.links(frame, tree_nodes)).collect()}
    roots = components_of(values, lambda i, j: ((values[i] ^ values[j]) & (2**64 - 1)).bit_count() <= 3)
    groups = {}
    for v, r in zip(values, roots):
        groups.setdefault(r, set()).add(v)
    assert {frozenset(g) for g in groups.values()} == {
        frozenset(v for v in out if out[v] == r) for r in set(out.values())
    }


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (-7, 3)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    out = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    assert {out[i] for i in range(101)} == {-7} and {out[1000 + i] for i in range(200)} == {1000}
    assert connected_components(frame.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = np.array([plain_fingerprint(r["text"]) for r in docs], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    roots = components_of(docs, lambda i, j: near[i, j])
    least = {}
    for r, root in zip(docs, roots):
        least[root] = min(r["doc_id"], least.get(root, r["doc_id"]))
    want = {r["doc_id"]: least[root] for r, root in zip(docs, roots)}
    out = QUERIES["op5_simhash"](spark, sf_dir)
    assert {r["doc_id"]: r["component_id"] for r in out.select("doc_id", F.col("component_id")).collect()} == want
