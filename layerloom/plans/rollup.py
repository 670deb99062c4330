"""Overview totals by month and group that add up, distinct counts included.

Distinct encounters and patients are kept as bitmaps over dense ids, a row per
group and bucket of 32,768 ids. Bitmaps of several groups are joined by OR and then
counted, so coarser groups, ranges of months and the grand total are exact without
the rows. Encounters are numbered by day, so a month's ids share few buckets.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.dates import month_label
from layerloom.operators.keys import dense_key
from layerloom.operators.staging import write_through

GROUPS = ("encounter_month", "treatment", "stage", "payment_status", "provider_specialty")
#: Counted distinct: output name and column.
DISTINCT = {"encounter_count": "encounter_id", "patient_count": "patient_id"}


@dataclass(frozen=True)
class Rollup:
    """``facts``: sums and counts per group. ``bitmaps``: ``measure``, ``bucket`` and ``bits`` per group."""

    facts: DataFrame
    bitmaps: DataFrame
    groups: tuple[str, ...] = GROUPS


def _numbered(rows: DataFrame, groups: Sequence[str], column: str) -> DataFrame:
    """The different values of ``column`` in each group by their dense number; NULL has none."""
    rows = rows.where(F.col(column).isNotNull())
    first = rows.groupBy(column).agg(F.min("encounter_date").alias("_day"))
    numbers = dense_key(first, ["_day", column], "_number").select(column, "_number")
    return rows.select(*groups, column).distinct().join(numbers, column).drop(column)


def build_rollup(overview: DataFrame, groups: Sequence[str] = GROUPS) -> Rollup:
    """From the overview's rows, read once; both tables are stored.

    A bitmap of few ids is far larger than these, so ids are brought together first and each bitmap is made once.
    """
    rows = write_through(
        overview.withColumn("encounter_month", month_label(F.col("encounter_date"))).select(
            *groups, "encounter_date", *DISTINCT.values(), "billing_amount", "treatment_response_score"
        ),
        "rollup-rows",
    )
    facts = rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("billing_amount").alias("billed"),
        F.count("billing_amount").alias("priced"),
        F.sum("treatment_response_score").alias("score"),
        F.count("treatment_response_score").alias("scored"),
    )
    bitmaps = None
    for measure, column in DISTINCT.items():
        bits = (
            _numbered(rows, groups, column)
            .select(
                *groups,
                F.bitmap_bucket_number("_number").alias("bucket"),
                F.bitmap_bit_position("_number").cast("int").alias("_bit"),
            )
            .repartition(*groups, "bucket")
            .groupBy(*groups, "bucket")
            .agg(F.bitmap_construct_agg(F.col("_bit").cast("bigint")).alias("bits"))
            .select(*groups, F.lit(measure).alias("measure"), "bucket", "bits")
        )
        bitmaps = bits if bitmaps is None else bitmaps.unionByName(bits)
    return Rollup(write_through(facts, "rollup-facts"), write_through(bitmaps, "rollup-bitmaps"), tuple(groups))


def _mean(total: str, n: Column) -> Column:
    """As ``avg`` of a decimal(18,2) has it."""
    return (F.sum(total) / F.nullif(F.sum(n), F.lit(0).cast("bigint"))).cast("decimal(22,6)")


def roll_up(rollup: Rollup, by: Sequence[str] = (), where: Column | None = None) -> DataFrame:
    """Every measure per value of ``by``, some of the rollup's groups; ``where`` may use any of them.

    Sums and counted bitmaps are stacked and added up per group, which needs no join and so keeps NULL groups.
    """
    unknown = set(by) - set(rollup.groups)
    if unknown:
        raise KeyError(f"the rollup has no groups {sorted(unknown)}")
    facts, bitmaps = rollup.facts, rollup.bitmaps
    if where is not None:
        facts, bitmaps = facts.where(where), bitmaps.where(where)
    joined = bitmaps.groupBy(*by, "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = joined.select(
        *by, *[F.when(F.col("measure") == m, F.bitmap_count("bits")).alias(m) for m in DISTINCT]
    )
    stacked = facts.select(*by, "n", "billed", "priced", "score", "scored").unionByName(counted, allowMissingColumns=True)
    zero = F.lit(0).cast("bigint")
    return stacked.groupBy(*by).agg(
        *[F.coalesce(F.sum(m), zero).alias(m) for m in DISTINCT],
        F.sum("billed").alias("total_billing_amount"),
        _mean("billed", F.col("priced")).alias("avg_billing_amount"),
        _mean("billed", F.col("n")).alias("avg_billing_zero_filled"),
        _mean("score", F.col("scored")).alias("avg_treatment_response_score"),
    )


def kpi_from_rollup(rollup: Rollup, where: Column | None = None) -> DataFrame:
    """``kpi_summary`` without the rows; the zero-filled mean of groups without any amount is 0."""
    total = roll_up(rollup, where=where)
    zero_filled = F.when(
        (F.col("encounter_count") > 0) & F.col("avg_billing_zero_filled").isNull(), F.lit(0).cast("decimal(22,6)")
    ).otherwise(F.col("avg_billing_zero_filled"))
    return total.select(
        F.col("encounter_count").alias("encounters"),
        F.col("patient_count").alias("patients"),
        F.coalesce("total_billing_amount", F.lit(0)).alias("revenue"),
        F.col("avg_billing_amount").alias("avg_billing"),
        zero_filled.alias("avg_billing_zero_filled"),
    )
