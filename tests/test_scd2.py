"""Versioned dimensions: stated sequences, invariants and a plain-Python model."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerloom.operators import staging
from layerloom.operators.scd2 import compare_snapshot, current_versions, scd2_merge, seed_dimension
from plans import physical_plan

KEYS, TRACKED, SK = ["k"], ["v"], "sk"
T = [f"2024-01-0{i} 00:00:00" for i in range(1, 10)]


def snapshot(spark, values, note="n"):
    return spark.createDataFrame([(k, v, note) for k, v in values.items()], "k int, v string, note string")


def versions(dimension):
    return sorted(
        (
            (r.k, r.v, r.sk, str(r.valid_from), str(r.valid_to) if r.valid_to else None, r.is_current)
            for r in dimension.collect()
        ),
        key=repr,
    )


def load(spark, *snapshots, **options):
    dimension = seed_dimension(
        snapshot(spark, snapshots[0]),
        KEYS,
        TRACKED,
        SK,
        T[0],
        null_safe_hash=options.get("null_safe_hash", False),
    )
    for ts, values in zip(T[1:], snapshots[1:]):
        dimension = scd2_merge(dimension, snapshot(spark, values), KEYS, TRACKED, SK, ts, **options)
    return dimension


def test_unchanged_changed_new_and_absent(spark):
    assert versions(load(spark, {1: "a", 2: "a", 4: "a"}, {1: "a", 2: "b", 3: "a"})) == sorted(
        [
            (1, "a", 1, T[0], None, True),
            (2, "a", 2, T[0], T[1], False),
            (2, "b", 4, T[1], None, True),
            (3, "a", 5, T[1], None, True),
            (4, "a", 3, T[0], None, True),
        ],
        key=repr,
    )


def test_a_value_that_comes_back_is_a_third_version(spark):
    found = versions(load(spark, {5: "a"}, {5: "b"}, {5: "a"}))
    assert [(v, sk, current) for _, v, sk, _, _, current in found] == [("a", 1, False), ("a", 3, True), ("b", 2, False)]


def test_null_to_empty_counts_as_a_change_only_with_the_null_safe_hash(spark):
    assert len(versions(load(spark, {6: None}, {6: ""}))) == 1
    assert len(versions(load(spark, {6: None}, {6: ""}, null_safe_hash=True))) == 2


def test_the_same_snapshot_again_changes_nothing(spark):
    once = load(spark, {1: "a", 2: "a"}, {1: "b", 3: "c"})
    again = scd2_merge(once, snapshot(spark, {1: "b", 3: "c"}), KEYS, TRACKED, SK, T[2])
    assert versions(again) == versions(once)


def test_missing_keys_can_be_closed(spark):
    found = versions(load(spark, {1: "a", 2: "a"}, {1: "a"}, close_missing=True))
    assert found == [(1, "a", 1, T[0], None, True), (2, "a", 2, T[0], T[1], False)]


def test_untracked_columns_alone_make_no_version(spark):
    dimension = load(spark, {1: "a"})
    merged = scd2_merge(dimension, snapshot(spark, {1: "a"}, note="other"), KEYS, TRACKED, SK, T[1])
    assert [(r.v, r.note) for r in merged.collect()] == [("a", "n")]


def test_an_empty_dimension_is_seeded_from_one(spark):
    empty = load(spark, {1: "a"}).limit(0)
    merged = scd2_merge(empty, snapshot(spark, {9: "x", 8: "y"}), KEYS, TRACKED, SK, T[1])
    assert versions(merged) == [(8, "y", 1, T[1], None, True), (9, "x", 2, T[1], None, True)]


def test_many_keys_are_numbered_over_their_order(spark):
    first = {k: "a" for k in range(300)}
    second = {k: ("a" if k % 3 else "b") for k in range(100, 500)}
    rows = versions(load(spark, first, second))
    fresh = sorted(r for r in rows if r[2] > 300)
    assert [r[2] for r in fresh] == list(range(301, 301 + len(fresh)))
    assert [r[0] for r in fresh] == [k for k in range(100, 500) if k >= 300 or k % 3 == 0]
    staging.clear_staged(spark)


def test_history_takes_no_part_in_the_join(spark):
    dimension = load(spark, {1: "a"}, {1: "b"})
    compared = compare_snapshot(dimension, snapshot(spark, {1: "c"}), KEYS, TRACKED, SK, T[2])
    assert {(r.change, r.v) for r in compared.collect()} == {("expired", "b"), ("new", "c")}


def test_each_side_is_shuffled_once(spark, tmp_path):
    spark.range(1000).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"), F.lit("n").alias("note")).write.parquet(
        str(tmp_path / "in")
    )
    load(spark, {1: "a"}).write.parquet(str(tmp_path / "dim"))
    plan = physical_plan(
        compare_snapshot(
            spark.read.parquet(str(tmp_path / "dim")), spark.read.parquet(str(tmp_path / "in")), KEYS, TRACKED, SK, T[1]
        )
    )
    assert plan.count("Exchange hashpartitioning") == 2
    assert "PushedFilters: [IsNotNull(is_current), EqualTo(is_current,true)]" in plan


def model(snapshots):
    """The same contract over dictionaries."""
    out, next_key = [], 1
    for ts, values in zip(T, snapshots):
        current = {row[0]: row for row in out if row[5]}
        for k in sorted(values):
            old = current.get(k)
            if old is not None and (old[1] or "") == (values[k] or ""):
                continue
            if old is not None:
                out[out.index(old)] = (*old[:4], ts, False)
            out.append((k, values[k], next_key, ts, None, True))
            next_key += 1
    return sorted(out, key=repr)


snapshots = st.lists(
    st.dictionaries(st.integers(0, 5), st.sampled_from(["a", "b", "", None]), min_size=1, max_size=5), min_size=1, max_size=4
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(snapshots)
def test_any_sequence_follows_the_model(spark, sequence):
    dimension = load(spark, *sequence)
    found = versions(dimension)
    assert found == model(sequence)
    assert sorted(v[2] for v in found) == list(range(1, len(found) + 1))
    current = [r.k for r in current_versions(dimension).select("k").collect()]
    assert len(current) == len(set(current))


@pytest.mark.parametrize("width", [1, 4, 64])
def test_result_does_not_depend_on_the_shuffle_width(spark, width):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        sequence = [{k: "a" for k in range(40)}, {k: "ab"[k % 2] for k in range(20, 60)}]
        assert versions(load(spark, *sequence)) == model(sequence)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
