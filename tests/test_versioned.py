"""Dimensions stored by ranges: same rows as the whole merge, and only changed ranges written."""

import random
from pathlib import Path

import pytest

from layerloom.operators.scd2 import scd2_merge, seed_dimension
from layerloom.sources.versioned import VersionedDimension, fold_levels
from plans import rows

KEYS, TRACKED, SK = ["k"], ["v"], "sk"
T = [f"2024-01-{i:02d} 00:00:00" for i in range(1, 20)]


def snapshot(spark, values):
    return spark.createDataFrame(sorted(values.items()), "k bigint, v string")


def store(spark, tmp_path, rows_per_range=20):
    return VersionedDimension(spark, str(tmp_path / "dim"), KEYS, TRACKED, SK, rows_per_range)


def files(tmp_path):
    return {p for p in Path(tmp_path).rglob("*.parquet")}


@pytest.mark.parametrize("close_missing", [False, True])
def test_equals_the_whole_merge_over_many_batches(spark, tmp_path, close_missing):
    rng = random.Random(3)
    values = {k * 3: "a" for k in range(100)}
    dimension = store(spark, tmp_path)
    state = dimension.apply(None, snapshot(spark, values), "0", T[0])
    whole = seed_dimension(snapshot(spark, values), KEYS, TRACKED, SK, T[0])
    assert len(state["ranges"]) > 3
    for n in range(1, 5):
        for k in rng.sample(sorted(values), 7):
            values[k] = rng.choice("abc")
        values |= {rng.randrange(-50, 500): "new" for _ in range(40 * (n % 2))}
        given = {k: v for k, v in values.items() if rng.random() > 0.05}
        state = dimension.apply(state, snapshot(spark, given), str(n), T[n], close_missing=close_missing)
        whole = scd2_merge(whole, snapshot(spark, given), KEYS, TRACKED, SK, T[n], close_missing=close_missing)
        assert rows(dimension.read(state)) == rows(whole.select(*dimension.read(state).columns))
        assert dimension.closed(state).where("is_current").count() == 0
        assert dimension.current(state).where("NOT is_current").count() == 0
        assert state["max_key"] == max(r.sk for r in whole.collect())
        assert sum(r["rows"] for r in state["ranges"]) == dimension.current(state).count()


def test_a_batch_writes_only_what_it_changes(spark, tmp_path):
    values = {k: "a" for k in range(200)}
    dimension = store(spark, tmp_path)
    state = dimension.apply(None, snapshot(spark, values), "0", T[0])
    before = files(tmp_path)
    assert dimension.apply(state, snapshot(spark, values), "1", T[1]) is state and files(tmp_path) == before

    one = dimension.apply(state, snapshot(spark, values | {77: "b"}), "1", T[1])
    kept = {r["path"] for r in state["ranges"]} & {r["path"] for r in one["ranges"]}
    assert len(kept) == len(state["ranges"]) - 1 and len(one["closed"]) == 1
    assert [tuple(r)[:3] for r in dimension.closed(one).select("k", "v", "sk").collect()] == [(77, "a", 78)]
    assert before <= files(tmp_path)  # what older readers read is still there
    assert rows(dimension.read(state)) == rows(dimension.current(state))

    # only new keys: no history is written
    more = dimension.apply(one, snapshot(spark, values | {77: "b", 1000: "n"}), "2", T[2])
    assert more["closed"] == one["closed"] and more["max_key"] == 202


def test_a_range_that_grows_is_split(spark, tmp_path):
    dimension = store(spark, tmp_path)
    state = dimension.apply(None, snapshot(spark, {k: "a" for k in range(40)}), "0", T[0])
    grown = dimension.apply(state, snapshot(spark, {k: "a" for k in range(400)}), "1", T[1])
    assert max(r["rows"] for r in grown["ranges"]) < 2 * dimension.rows_per_range + 20
    assert rows(dimension.read(grown).select("k")) == [(k,) for k in sorted(range(400), key=lambda k: repr((k,)))]
    # and many bounds are still told apart
    assert len(grown["ranges"]) > 16
    last = dimension.apply(grown, snapshot(spark, {399: "z"}), "2", T[2])
    assert len({r["path"] for r in last["ranges"]} - {r["path"] for r in grown["ranges"]}) == 1


def test_two_keys_of_text_and_more_than_a_stride_of_ranges(spark, tmp_path):
    frame = spark.createDataFrame([(f"p{i % 90}", f"t{i // 90}", "v") for i in range(360)], "a string, b string, v string")
    dimension = VersionedDimension(spark, str(tmp_path / "two"), ["a", "b"], ["v"], "sk", 5)
    state = dimension.apply(None, frame, "0", T[0])
    assert len(state["ranges"]) > 40
    changed = frame.selectExpr("a", "b", "if(a = 'p7' AND b = 't2', 'w', v) AS v")
    after = dimension.apply(state, changed, "1", T[1])
    assert len({r["path"] for r in after["ranges"]} - {r["path"] for r in state["ranges"]}) == 1
    assert dimension.read(after).count() == 361 and dimension.current(after).where("v = 'w'").count() == 1


def test_an_empty_first_load(spark, tmp_path):
    dimension = store(spark, tmp_path)
    state = dimension.apply(None, spark.createDataFrame([], "k bigint, v string"), "0", T[0])
    assert dimension.read(state).count() == 0
    state = dimension.apply(state, snapshot(spark, {1: "a"}), "1", T[1])
    assert dimension.read(state).count() == 1 and state["max_key"] == 1


@pytest.mark.parametrize("fan_in", [2, 3, 16])
def test_levels_count_like_digits(fan_in):
    levels, sizes = [], []
    for n in range(1, 400):
        levels = fold_levels(levels, fan_in)
        kept = len(levels) - 1
        sizes = [*sizes[:kept], sum(sizes[kept:]) + 1]
        assert sizes == [fan_in**level for level in levels] and sum(sizes) == n
        assert levels == sorted(levels, reverse=True) and max(map(levels.count, levels)) < fan_in
    with pytest.raises(ValueError):
        VersionedDimension(None, "", KEYS, TRACKED, SK, fan_in=1)


def test_history_stays_in_few_folders(spark, tmp_path):
    dimension = VersionedDimension(spark, str(tmp_path / "dim"), KEYS, TRACKED, SK, 20, fan_in=2)
    values = {k: "0" for k in range(40)}
    state = dimension.apply(None, snapshot(spark, values), "0", T[0])
    whole = seed_dimension(snapshot(spark, values), KEYS, TRACKED, SK, T[0])
    for n in range(1, 8):
        values |= {n: str(n), 0: str(n)}
        before = state
        older = rows(dimension.read(before))
        state = dimension.apply(state, snapshot(spark, values), str(n), T[n])
        whole = scd2_merge(whole, snapshot(spark, values), KEYS, TRACKED, SK, T[n])
        assert len(state["closed"]) == len(state["levels"]) == n.bit_count()
        assert rows(dimension.read(before)) == older  # readers of the older state
    assert dimension.closed(state).count() == 14
    assert rows(dimension.read(state)) == rows(whole.select(*dimension.read(state).columns))
    # a batch without changes, one of new keys alone, and a state of before folders were merged
    assert dimension.apply(state, snapshot(spark, values), "8", T[8]) is state
    more = dimension.apply(state, snapshot(spark, values | {99: "n"}), "8", T[8])
    assert (more["closed"], more["levels"]) == (state["closed"], state["levels"])
    del state["levels"]
    last = dimension.apply(state, snapshot(spark, values | {5: "z"}), "9", T[9])
    assert dimension.closed(last).count() == 15
