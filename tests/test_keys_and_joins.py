import random
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from layerloom.operators import staging
from layerloom.operators.dedupe import drop_exact_duplicates, first_per_key, latest_per_key
from layerloom.operators.keys import dense_key, max_key
from layerloom.operators.skew import _spread, fits_broadcast, hot_keys, left_join
from plans import physical_plan, rows


@pytest.fixture
def width(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("width", [1, 4, 64], indirect=True)
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_keys_equal_the_plain_window(spark, width, kind):
    df = spark.range(5_000).select((F.xxhash64("id") % 1_000_000).cast(kind).alias("a"), F.col("id").alias("b"))
    plain = df.withColumn("sk", F.row_number().over(Window.orderBy("a", "b")).cast("bigint"))
    assert rows(dense_key(df, ["a", "b"], "sk")) == rows(plain)
    staging.clear_staged(spark)


def test_rows_are_numbered_without_a_single_task_sort(spark):
    placed = dense_key(spark.range(5_000), ["id"], "sk")
    plan = physical_plan(placed)
    # The only single-task window runs over the per-partition counts.
    assert plan.count("Window") == 1 and plan.index("BroadcastExchange") < plan.index("Window")
    assert placed.agg(F.min("sk"), F.max("sk"), F.count_distinct("sk")).first()[:] == (1, 5_000, 5_000)
    assert dense_key(spark.range(0), ["id"], "sk").count() == 0
    staging.clear_staged(spark)


def test_keys_continue_from_a_base(spark):
    df = spark.range(3)
    base = max_key(spark.createDataFrame([(40,), (7,)], "sk bigint"), "sk")
    assert rows(dense_key(df, ["id"], "sk", base=base), "id") == [(0, 41), (1, 42), (2, 43)]
    assert spark.range(1).select(max_key(spark.createDataFrame([], "sk bigint"), "sk")).first()[0] == 0


def test_staged_files_go_to_the_named_folder_and_are_cleared(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    staged = staging.write_through(spark.range(10), "probe")
    assert staged.count() == 10 and list(folder.glob("probe-*"))
    staging.clear_staged(spark)
    assert not list(folder.glob("probe-*"))


def test_a_scope_clears_its_own_files_also_after_a_failure(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    outside = staging.write_through(spark.range(3), "outside")
    with pytest.raises(RuntimeError), staging.staging_scope(spark):
        staging.write_through(spark.range(3), "inside")
        raise RuntimeError
    assert not list(folder.glob("inside-*")) and outside.count() == 3
    staging.clear_staged(spark)


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.staging_root(Session)


def test_latest_row_wins_and_null_counts_as_oldest(spark):
    df = spark.createDataFrame(
        [("a", None, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "q"), (None, 1, "n"), (None, 3, "m")],
        "k string, ts int, v string",
    )
    assert rows(latest_per_key(df, ["k"], ["ts"]), "k") == [(None, 3, "m"), ("a", 2, "y"), ("b", None, "q")]


def test_pick_does_not_depend_on_row_order(spark):
    values = [(k, random.Random(k).random(), i) for k in range(20) for i in range(5)]
    picks = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        df = spark.createDataFrame(values, "k int, v double, i int").repartition(seed + 1)
        picks.add(tuple(rows(first_per_key(df, ["k"], ["i"]), "k")))
    assert len(picks) == 1


def test_a_key_sends_one_row_per_task(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    plan = physical_plan(latest_per_key(df, ["k"], ["ts"]))
    assert "Partial" in plan and "Final" in plan and "WindowGroupLimit" in plan


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (1, "a"), (2, "a")], "k int, v string")
    assert rows(drop_exact_duplicates(df)) == [(1, "a"), (1, None), (2, "a")]
    assert drop_exact_duplicates(df, ["k"]).count() == 2


def _skewed(spark):
    left = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 10 == 1, None)
        .otherwise(F.col("id") % 50)
        .cast("bigint")
        .alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(200).select(
        F.when(F.col("id") < 70, 7).when(F.col("id") < 80, None).otherwise(F.col("id") % 40).cast("bigint").alias("k"),
        F.col("id").alias("r"),
    )
    return left, right


def listed(spark, splits):
    return spark.createDataFrame([(*k, n) for k, n in splits.items()], "k bigint, splits int") if splits else None


@pytest.mark.parametrize("split_left, split_right", [(True, False), (False, True), (True, True), (False, False)])
def test_split_join_equals_the_plain_join(spark, split_left, split_right):
    left, right = _skewed(spark)
    limits = {"rows_per_task": 10, "sample_rate": 1.0}
    left_hot = hot_keys(left, ["k"], **limits) if split_left else None
    right_hot = hot_keys(right, ["k"], **limits) if split_right else None
    joined = left_join(left, right, ["k"], left_hot=left_hot, right_hot=right_hot, broadcast=False)
    plain = left.join(right, "k", "left").select("k", "l", "r")
    assert rows(joined.select("k", "l", "r")) == rows(plain)


def test_copies_are_dealt_out_and_all_come_back(spark):
    left = spark.createDataFrame([(1, "l")] * 50 + [(1, "m")] * 3 + [(2, "l"), (None, "n"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(1, "r")] * 40 + [(1, "s"), (3, "t"), (None, "u")], "k int, r string")
    for left_hot, right_hot in (({(1,): 4}, {(1,): 8}), ({(1,): 7, (None,): 2}, {}), ({}, {(1,): 3, (3,): 2})):
        hot = {"left_hot": listed(spark, left_hot), "right_hot": listed(spark, right_hot)}
        joined = left_join(left, right, ["k"], **hot, broadcast=False)
        assert rows(joined) == rows(left.join(right, "k", "left"))


def test_copies_leave_a_task_as_one_row_per_slot(spark):
    left = spark.createDataFrame([(1, "l")] * 50, "k int, l string")
    placed = _spread(left.withColumn("_left_splits", F.lit(4)), "_left_splits", "_a", "_copies", False)
    assert sorted(r._copies for r in placed.collect()) == [12, 12, 13, 13]
    assert len({r._a for r in placed.collect()}) == 4


def test_hot_keys_names_heavy_keys_and_null(spark):
    left, _ = _skewed(spark)
    found = hot_keys(left, ["k"], rows_per_task=30, sample_rate=1.0)
    assert {(r.k,): r.splits for r in found.collect()} == {(7,): 7, (None,): 2}


def test_every_key_over_the_limit_is_listed(spark):
    many = spark.range(15_000).select((F.col("id") % 3_000).alias("k"))
    assert hot_keys(many, ["k"], rows_per_task=4, sample_rate=1.0).count() == 3_000


def test_hot_key_is_spread_over_its_splits(spark):
    left, right = _skewed(spark)
    joined = left_join(left, right.select("k").distinct(), ["k"], left_hot=listed(spark, {(7,): 8}), broadcast=False)
    plan = physical_plan(joined)
    assert "xxhash64" in plan and "Generate explode" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_without_hot_keys_the_join_is_plain(spark):
    left, right = _skewed(spark)
    assert hot_keys(left, ["k"]) is None
    assert "Generate" not in physical_plan(left_join(left, right, ["k"]))


def test_a_small_right_side_is_broadcast_despite_hot_keys(spark):
    left, right = _skewed(spark)
    joined = left_join(left, right, ["k"], left_hot=listed(spark, {(7,): 8}))
    plan = physical_plan(joined)
    assert fits_broadcast(right) and "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "Generate" not in plan


def test_many_key_columns_and_unmatched_keys(spark):
    left = spark.createDataFrame([(1, "a", i) for i in range(20)] + [(2, None, 99), (3, "c", 98)], "x int, y string, l int")
    right = spark.createDataFrame([(1, "a", "m"), (1, "a", "n"), (2, None, "o")], "x int, y string, r string")
    limits = {"rows_per_task": 1, "sample_rate": 1.0}
    joined = left_join(
        left, right, ["x", "y"], left_hot=hot_keys(left, ["x", "y"], **limits), right_hot=hot_keys(right, ["x", "y"], **limits),
        broadcast=False,
    )
    assert rows(joined) == rows(left.join(right, ["x", "y"], "left"))


def test_rows_are_not_sorted_to_look_their_splits_up(spark):
    """A list of hot keys too long to broadcast is hashed; every row used to be sorted for it."""
    left, right = _skewed(spark)
    hot = hot_keys(left, ["k"], rows_per_task=10, sample_rate=1.0)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, "-1")
        joined = left_join(left, right, ["k"], left_hot=hot, broadcast=False)
        plan = physical_plan(joined)
        assert rows(joined.select("k", "l", "r")) == rows(left.join(right, "k", "left").select("k", "l", "r"))
    finally:
        spark.conf.set(limit, before)
    assert plan.count("ShuffledHashJoin") == 2 and plan.count("SortMergeJoin") == 1
