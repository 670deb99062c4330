"""Left joins that stay balanced when one key holds much of a table.

Keys with too many rows are found from a sample and given a number of splits.
Rows of such a key are spread over its splits by a hash of their content, and
the other side's rows of that key are repeated once per split. Exact copies of
a row, which hash alike, are counted first, dealt out over the splits as
counts, and written out again after the join. Which keys were found affects
balance only: every key is joined in full either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.operators.staging import write_through

# Rows of one key that a single task can take without becoming a straggler.
ROWS_PER_TASK = 2_000_000
SAMPLE_RATE = 0.001

# One row per key over the limit: its key columns and ``splits``.
HotKeys = DataFrame


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    *,
    rows_per_task: int = ROWS_PER_TASK,
    sample_rate: float = SAMPLE_RATE,
) -> HotKeys | None:
    """Keys estimated above ``rows_per_task`` rows, each with its number of splits; None without any.

    All such keys are listed: there are at most as many as the table has
    multiples of ``rows_per_task``. The list is written, so Spark knows its size
    when it picks how to join it.
    """
    sampled = df.select(*keys)
    if sample_rate < 1.0:
        sampled = sampled.sample(sample_rate, seed=17)
    per_split = rows_per_task * sample_rate
    found = write_through(
        sampled.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > per_split)
        .select(*keys, F.ceil(F.col("_n") / per_split).cast("int").alias("splits")),
        "hot-keys",
    )
    return None if found.isEmpty() else found


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate of ``df`` is under the session's broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def _all_splits(keys: Sequence[str], left_hot: HotKeys | None, right_hot: HotKeys | None) -> DataFrame:
    """Split counts of both sides per key, 1 where a side has none."""
    sides = []
    for hot, own, other in ((left_hot, "_left_splits", "_right_splits"), (right_hot, "_right_splits", "_left_splits")):
        if hot is not None:
            sides.append(
                hot.select(
                    *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("splits").alias(own), F.lit(1).alias(other)
                )
            )
    both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1])
    return both.groupBy(*[f"_key_{k}" for k in keys]).agg(
        F.max("_left_splits").alias("_left_splits"), F.max("_right_splits").alias("_right_splits")
    )


def _with_splits(df: DataFrame, keys: Sequence[str], splits: DataFrame) -> DataFrame:
    """Attach each row's split counts."""
    on = None
    for k in keys:
        match = df[k].eqNullSafe(splits[f"_key_{k}"])
        on = match if on is None else on & match
    if not fits_broadcast(splits):
        # One row per key and far fewer than the rows they are looked up for, which this saves sorting.
        splits = splits.hint("shuffle_hash")
    return df.join(splits, on, "left").select(
        *[df[c] for c in df.columns],
        *[F.coalesce(splits[c], F.lit(1)).alias(c) for c in ("_left_splits", "_right_splits")],
    )


def _spread(df: DataFrame, own: str, own_slot: str, copies: str, distinct: bool) -> DataFrame:
    """Place each row in one of its key's own slots, by a hash of its content.

    Copies become one row per slot they reach, with the number that belongs there.
    """
    content = df.columns
    first = F.pmod(F.xxhash64(*content), F.col(own)).cast("int")
    if distinct:
        return df.withColumns({own_slot: first, copies: F.lit(1).cast("bigint")})
    counted = df.groupBy(*content).agg(F.count(F.lit(1)).alias("_n"))
    step = F.explode(F.sequence(F.lit(0), (F.least(F.col("_n"), F.col(own)) - 1).cast("int")))
    share = F.floor(F.col("_n") / F.col(own)) + (F.col("_step") < F.pmod("_n", F.col(own))).cast("bigint")
    return (
        counted.withColumn("_step", step)
        .withColumns({own_slot: F.pmod(first + F.col("_step"), F.col(own)).cast("int"), copies: share})
        .drop("_n", "_step")
    )


def _repeat(df: DataFrame, other: str, other_slot: str, needed: bool) -> DataFrame:
    """Give each row to every slot the other side may have put its key in."""
    slots = F.explode(F.sequence(F.lit(0), F.col(other) - 1)) if needed else F.lit(0)
    return df.withColumn(other_slot, slots)


def _unspread(df: DataFrame, own_slot: str, copies: str) -> DataFrame:
    return df.withColumns({own_slot: F.lit(0), copies: F.lit(1).cast("bigint")})


def _join_dealing_nulls(left: DataFrame, right: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """The left join on ``key`` and a second key that repeats it, or stands in for NULL; a row without ``key`` matches nothing."""
    a = left.withColumn("_deal", F.coalesce(key, F.xxhash64(*by)))
    b = right.withColumn("_deal", F.col(key))
    return a.join(b, [key, "_deal"], "left").select(*left.columns, *[c for c in right.columns if c != key])


def left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    *,
    left_hot: HotKeys | None = None,
    right_hot: HotKeys | None = None,
    left_distinct: bool = False,
    deal_nulls_by: Sequence[str] = (),
    broadcast: bool = True,
) -> DataFrame:
    """``left.join(right, keys, "left")``, split where the hot keys say so.

    ``right_hot`` must only hold keys that occur in ``right``. With
    ``left_distinct`` the caller says that left rows are not exact copies of
    each other, which saves a shuffle to count them; if they are, the result
    is the same but they share a task. Without hot keys, or with a right side
    that Spark broadcasts, this is the plain join: then no left row moves.
    ``broadcast=False`` splits however small the right side is. With one integer
    key, ``deal_nulls_by`` names columns whose hash deals left rows without the
    key over the tasks of the plain join, however many there are.
    """
    if right_hot is not None:
        right_hot = right_hot.dropna(subset=list(keys))
    small = broadcast and fits_broadcast(right)
    if (left_hot is None and right_hot is None) or small:
        if deal_nulls_by and not small:
            return _join_dealing_nulls(left, right, keys[0], deal_nulls_by)
        return left.join(right, list(keys), "left")
    splits = _all_splits(keys, left_hot, right_hot)

    a, b = _with_splits(left, keys, splits), _with_splits(right, keys, splits)
    a = _spread(a, "_left_splits", "_a", "_left_n", left_distinct) if left_hot is not None else _unspread(a, "_a", "_left_n")
    b = _spread(b, "_right_splits", "_b", "_right_n", False) if right_hot is not None else _unspread(b, "_b", "_right_n")
    a = _repeat(a, "_right_splits", "_b", right_hot is not None)
    b = _repeat(b, "_left_splits", "_a", left_hot is not None).drop("_left_splits", "_right_splits")
    joined = a.join(b, [*keys, "_a", "_b"], "left")
    if right_hot is not None:
        # A key split on the right has matches, so a copy that met none is surplus.
        joined = joined.where((F.col("_right_splits") == 1) | F.col("_right_n").isNotNull())
    output = [*left.columns, *[c for c in right.columns if c not in keys]]
    if right_hot is not None or not left_distinct:
        times = F.col("_left_n") * F.coalesce("_right_n", F.lit(1))
        joined = joined.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), times)))
    return joined.select(*output)
