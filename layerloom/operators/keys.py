"""Dense surrogate keys: ``row_number() over (order by keys)`` without the single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.operators.staging import write_through


def dense_key(df: DataFrame, keys: Sequence[str], name: str, *, base: Column | None = None) -> DataFrame:
    """Add ``name`` = base + 1..n over ``keys``, which must be unique.

    Rows are range partitioned and sorted, and each row's partition and position
    are written down with it, so that the offsets (one per partition) and the
    numbering read the same facts. The plan is the same at every size; the
    session's shuffle width sets how many rows a partition has.
    """
    offset = F.lit(0).cast("bigint") if base is None else base
    placed = write_through(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select(
            "*",
            F.spark_partition_id().alias("_part"),
            # The low 33 bits count rows inside the partition.
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
        ),
        "dense-key",
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    )
    # One row per range partition: as many as the shuffle width, so the broadcast is bounded.
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_pos") + 1 + offset)
        .select(*df.columns, name)
    )


def max_key(df: DataFrame, name: str) -> Column:
    """The highest key in ``df``, 0 if it has none, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint")).scalar()
