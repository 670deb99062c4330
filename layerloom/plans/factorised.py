"""Marts of the ``"all"`` mode without its rows.

There an encounter has a row for each of its patient's catalog rows and each of its
bills. What the marts sum up over those rows factorises: an encounter weighs as many
catalog rows as its patient has (one, if none), and its bills are summed up before
they meet it. So nothing is ever repeated, however many matches a key has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.operators.quality import dq_rows
from layerloom.operators.skew import hot_keys, left_join
from layerloom.operators.star import assign_providers


def _at_least_one(matches: str) -> Column:
    return F.greatest(F.coalesce(F.col(matches), F.lit(0)), F.lit(1))


def weighted_encounters(encounters: DataFrame, catalog: DataFrame) -> DataFrame:
    """Encounters with ``weight``, their rows by catalog matches alone."""
    matches = catalog.where(F.col("patient_id").isNotNull()).groupBy("patient_id").agg(F.count(F.lit(1)).alias("_matches"))
    rows = left_join(encounters, matches, ["patient_id"], left_hot=hot_keys(encounters, ["patient_id"]))
    return rows.withColumn("weight", _at_least_one("_matches")).drop("_matches")


def _billed(billing: DataFrame, *groups: str) -> DataFrame:
    return (
        billing.where(F.col("encounter_id").isNotNull())
        .groupBy("encounter_id", *groups)
        .agg(
            F.count(F.lit(1)).alias("bills"), F.sum("amount").alias("billed"), F.count("amount").alias("priced")
        )
    )


def _with_bills(encounters: DataFrame, catalog: DataFrame, billing: DataFrame) -> DataFrame:
    """One row per encounter row, with how many rows it stands for."""
    rows = weighted_encounters(encounters, catalog).join(_billed(billing), "encounter_id", "left")
    return rows.withColumn("rows", F.col("weight") * _at_least_one("bills"))


def _mean(total: Column, n: Column) -> Column:
    """As ``avg`` of a decimal(18,2) has it."""
    return (total / F.nullif(n, F.lit(0).cast("bigint"))).cast("decimal(22,6)")


def _billing_measures() -> list[Column]:
    total, priced = F.sum(F.col("billed") * F.col("weight")), F.sum(F.col("priced") * F.col("weight"))
    return [total.alias("total_billing_amount"), _mean(total, priced).alias("avg_billing_amount")]


def financial_analytics_all(encounters: DataFrame, catalog: DataFrame, billing: DataFrame) -> DataFrame:
    """``financial_analytics`` over the fact of the ``"all"`` mode.

    Bills are one row per encounter, payer and status, so an encounter counts where its first row of
    a date and treatment does; the join's own order finds that row, and no task holds a set of ids.
    """
    rows = weighted_encounters(encounters, catalog).select("encounter_id", "encounter_date", "treatment", "weight")
    alike = ["encounter_id", "encounter_date", "treatment"]
    position = F.row_number().over(Window.partitionBy(*alike).orderBy(*alike))
    rows = rows.repartition("encounter_id").withColumn("_counted", F.when(position == 1, F.col("encounter_id")))
    rows = rows.join(_billed(billing, "insurance", "payment_status"), "encounter_id", "left")
    return rows.groupBy("encounter_date", "treatment", "insurance", "payment_status").agg(
        F.count("_counted").alias("encounter_count"), *_billing_measures()
    )


def provider_performance_all(
    encounters: DataFrame, catalog: DataFrame, billing: DataFrame, providers: DataFrame
) -> DataFrame:
    """``provider_performance`` over the fact of the ``"all"`` mode."""
    rows = assign_providers(_with_bills(encounters, catalog, billing), providers)
    score = F.col("treatment_response_score")
    scored = F.sum(F.when(score.isNotNull(), F.col("rows")))
    per_provider = rows.groupBy("provider_sk", "provider_id").agg(
        F.count_distinct("encounter_id").alias("encounter_count"),
        F.count_distinct("patient_id").alias("patient_count"),
        _mean(F.sum(score * F.col("rows")), scored).alias("avg_treatment_response_score"),
        *_billing_measures(),
    )
    names = providers.select("provider_sk", "provider_name", "specialty", "location")
    return per_provider.join(names, "provider_sk", "left").select(
        "provider_id",
        "provider_name",
        "specialty",
        "location",
        "encounter_count",
        "patient_count",
        "avg_treatment_response_score",
        "total_billing_amount",
        "avg_billing_amount",
    )


def dq_summary_all(encounters: DataFrame, catalog: DataFrame, billing: DataFrame) -> DataFrame:
    """``dq_summary`` over the overview of the ``"all"`` mode."""
    rows = _with_bills(encounters, catalog, billing)
    unpriced = F.col("rows") - F.col("weight") * F.coalesce("priced", F.lit(0))
    none = F.lit(0).cast("bigint")
    return dq_rows(
        rows.agg(
            F.coalesce(F.sum("rows"), none).alias("n"),
            F.coalesce(F.sum(unpriced), none).alias("no_amount"),
            F.coalesce(F.sum(F.when(F.col("encounter_date").isNull(), F.col("rows"))), none).alias("no_day"),
            F.count_distinct("encounter_id").alias("keys"),
            F.coalesce(F.max(F.col("encounter_id").isNull().cast("bigint")), none).alias("unkeyed"),
        )
    )
