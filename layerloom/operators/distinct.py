"""Aggregates whose distinct counts are worked out apart from each other.

Spark counts several distinct columns at once by repeating each row once per column, and
over grouping sets once more per set, so one task holds the ids of all of them. Here each
count has tasks of its own, which hold one key and one id per entry; the results are stacked
and added up per group, which needs no join and so keeps NULL groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.operators.staging import write_through

_ROWS = "_rows"


def distinct_count(rows: DataFrame, groups: Sequence[str], column: str, name: str) -> DataFrame:
    """``count_distinct(column)`` per group; groups without any value of it are left out."""
    ids = rows.where(F.col(column).isNotNull()).select(*groups, column).distinct()
    return ids.groupBy(*groups).agg(F.count(F.lit(1)).alias(name))


def stacked(measured: DataFrame, groups: Sequence[str], present: str, counts: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """``measured`` with each count, 0 where a group has none; ``present`` is a measure that is never NULL."""
    parts = [part for of_name in counts.values() for part in of_name]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [measured, *parts])
    others = [c for c in measured.columns if c not in groups]
    zero = F.lit(0).cast("bigint")
    return whole.groupBy(*groups).agg(
        F.max_by(F.struct(*others), present).alias("_of"), *[F.coalesce(F.sum(n), zero).alias(n) for n in counts]
    ).select(*groups, *counts, "_of.*")


def aggregate_apart(rows: DataFrame, groups: Sequence[str], distinct: Mapping[str, str], measures: Sequence[Column]) -> DataFrame:
    """``rows.groupBy(groups).agg(...)`` with a distinct count per entry of ``distinct`` (name: column), then ``measures``.

    ``rows`` is stored and read once per count, so pass no columns that aren't needed.
    """
    kept = write_through(rows, "distinct-rows")
    measured = kept.groupBy(*groups).agg(F.count(F.lit(1)).alias(_ROWS), *measures)
    counts = {name: [distinct_count(kept, groups, column, name)] for name, column in distinct.items()}
    return stacked(measured, groups, _ROWS, counts).drop(_ROWS)
