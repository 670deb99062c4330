"""One row per key, and exact-duplicate removal.

``row_number() = 1`` is planned with a group limit on both sides of the
shuffle, so a task sends at most one row per key: a key that holds a third of
the table costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_position", F.row_number().over(window)).where("_position = 1").drop("_position")


def _remaining(df: DataFrame, used: Sequence[str]) -> list[Column]:
    return [F.col(c).asc() for c in df.columns if c not in used]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The lowest row of each key by ``order``, ties broken by every other column."""
    ties = _remaining(df, [*keys, *order])
    ordering = [F.col(c).asc() for c in order] + ties
    return _one_per_key(df, keys, ordering or [F.lit(0)])


def latest_per_key(df: DataFrame, keys: Sequence[str], recency: Sequence[str]) -> DataFrame:
    """The row of each key with the highest ``recency`` (NULL counts as oldest).

    Remaining columns break ties in ascending order, so the pick is repeatable.
    """
    ties = _remaining(df, [*keys, *recency])
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in recency] + ties)


def drop_exact_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows that agree on ``columns`` (default: all of them).

    Over all columns this is an aggregation with map-side combine. Over some,
    the lowest row by the remaining columns survives.
    """
    if columns is None or set(columns) == set(df.columns):
        return df.distinct()
    return first_per_key(df, columns)
