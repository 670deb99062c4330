"""Semantic marts over the star tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.operators.distinct import aggregate_apart
from layerloom.operators.skew import ROWS_PER_TASK, SAMPLE_RATE, HotKeys, hot_keys, left_join
from layerloom.operators.star import keyed_encounters, rotate_providers, with_every_bill

# The columns of the overview.
OVERVIEW_COLUMNS = (
    "encounter_id",
    "encounter_date",
    "treatment",
    "drug_regimen",
    "number_of_cycles",
    "treatment_response_score",
    "outcome",
    "billing_amount",
    "insurance",
    "payment_status",
    "provider_id",
    "provider_name",
    "provider_specialty",
    "provider_location",
    "patient_id",
    "patient_name",
    "gender",
    "age",
    "smoking_status",
    "cancer_type",
    "stage",
)


def encounter_overview(
    fact: DataFrame,
    patients: DataFrame,
    catalog: DataFrame,
    providers: DataFrame,
    busy: dict[str, HotKeys | None] | None = None,
    *,
    broadcast: bool = True,
) -> DataFrame:
    """The fact with patient, cancer and provider attributes by surrogate key.

    Pass current versions to see the latest attributes, or whole dimensions to
    see those the fact was loaded with. Many fact rows may share one key, or
    have none. Each lookup uses another key, so adaptive execution can split
    such partitions by itself; over a written fact, ``busy_keys`` finds them
    beforehand. Rows without a key, which may be most, are dealt over the tasks. A dimension that Spark broadcasts needs no splits and gets none,
    unless ``broadcast`` is off.
    """

    # Encounter and billing id, kept until the end, tell the rows of a key apart.
    ids = ["encounter_id", "billing_id"]
    rows = _with_attributes(fact.drop("date_sk"), patients, catalog, providers, ids, busy or {}, broadcast)
    return rows.select(*OVERVIEW_COLUMNS)


def encounter_overview_all(
    encounters: DataFrame,
    patients: DataFrame,
    catalog: DataFrame,
    billing: DataFrame,
    providers: DataFrame,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    sample_rate: float = SAMPLE_RATE,
) -> DataFrame:
    """``encounter_overview`` of the ``"all"`` fact, straight from the entities.

    A bill's row has its encounter's attributes, so these are looked up before bills repeat the encounters.
    """
    limits = {"rows_per_task": rows_per_task, "sample_rate": sample_rate}
    rows = keyed_encounters(encounters, patients, catalog, providers, **limits)
    rows = _with_attributes(rows, patients, catalog, providers, ["encounter_id"])
    return with_every_bill(rows, billing, **limits).select(*OVERVIEW_COLUMNS)


def _with_attributes(
    rows: DataFrame,
    patients: DataFrame,
    catalog: DataFrame,
    providers: DataFrame,
    ids: Sequence[str],
    busy: Mapping[str, HotKeys | None] | None = None,
    broadcast: bool = True,
) -> DataFrame:
    """``rows`` with what their surrogate keys refer to; ``ids`` tell the rows of a key apart."""

    def lookup(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
        hot = (busy or {}).get(key)
        return left_join(
            rows, dimension, [key], left_hot=hot, left_distinct=True, deal_nulls_by=ids, broadcast=broadcast
        )

    rows = rows.drop("patient_id")
    rows = lookup(
        rows,
        patients.select("patient_sk", "patient_id", "patient_name", "gender", "age", "smoking_status"),
        "patient_sk",
    )
    rows = lookup(rows, catalog.select("cancer_sk", "cancer_type", "stage"), "cancer_sk")
    return lookup(
        rows,
        providers.select(
            "provider_sk",
            "provider_name",
            F.col("specialty").alias("provider_specialty"),
            F.col("location").alias("provider_location"),
        ),
        "provider_sk",
    )


def busy_keys(
    fact: DataFrame, *, rows_per_task: int = ROWS_PER_TASK, sample_rate: float = SAMPLE_RATE
) -> dict[str, HotKeys | None]:
    """Surrogate keys (NULL included) with very many fact rows, for ``encounter_overview``."""
    return {
        key: hot_keys(fact, [key], rows_per_task=rows_per_task, sample_rate=sample_rate)
        for key in ("patient_sk", "cancer_sk", "provider_sk")
    }


def financial_analytics(fact: DataFrame) -> DataFrame:
    """Encounters and billing per date, treatment, payer and payment status."""
    return fact.groupBy("encounter_date", "treatment", "insurance", "payment_status").agg(
        F.count_distinct("encounter_id").alias("encounter_count"),
        F.sum("billing_amount").alias("total_billing_amount"),
        F.avg("billing_amount").alias("avg_billing_amount"),
    )


def provider_performance(fact: DataFrame, providers: DataFrame) -> DataFrame:
    """Volume, response and billing per provider; attributes join after grouping."""
    per_provider = fact.groupBy("provider_sk", "provider_id").agg(
        F.count_distinct("encounter_id").alias("encounter_count"),
        F.count_distinct("patient_id").alias("patient_count"),
        F.avg("treatment_response_score").alias("avg_treatment_response_score"),
        F.sum("billing_amount").alias("total_billing_amount"),
        F.avg("billing_amount").alias("avg_billing_amount"),
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


def overview_from_files(
    patients: DataFrame,
    encounters: DataFrame,
    billing: DataFrame,
    catalog: DataFrame,
    providers: DataFrame,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    sample_rate: float = SAMPLE_RATE,
) -> DataFrame:
    """The overview built straight from the entities, with no star tables.

    Providers are dealt out in turn, billing matches on encounter and patient,
    and every catalog row of a patient counts.
    """
    limits = {"rows_per_task": rows_per_task, "sample_rate": sample_rate}
    busy_patients = hot_keys(encounters, ["patient_id"], **limits)
    names = providers.select(
        "provider_sk",
        "provider_name",
        F.col("specialty").alias("provider_specialty"),
        F.col("location").alias("provider_location"),
    )
    people = patients.select("patient_id", "patient_name", "gender", "age", "smoking_status")
    cancers = catalog.select("patient_id", "cancer_type", "stage")
    pair = ["encounter_id", "patient_id"]
    bills = billing.select(*pair, F.col("amount").alias("billing_amount"), "insurance", "payment_status")

    # Lookups come before the joins that repeat an encounter.
    rows = rotate_providers(encounters, providers).join(names, "provider_sk", "left").drop("provider_sk")
    rows = left_join(rows, people, ["patient_id"], left_hot=busy_patients)
    rows = left_join(
        rows,
        cancers,
        ["patient_id"],
        left_hot=busy_patients,
        right_hot=hot_keys(cancers, ["patient_id"], **limits),
    )
    return left_join(rows, bills, pair, right_hot=hot_keys(bills, pair, **limits))


def financial_from_files(overview: DataFrame) -> DataFrame:
    """``financial_analytics`` over ``overview_from_files``; groups with a NULL key are left out there."""
    keys = ["encounter_date", "treatment", "insurance", "payment_status"]
    rows = overview.dropna(subset=keys).select(*keys, "encounter_id", "billing_amount")
    return aggregate_apart(
        rows,
        keys,
        {"encounter_count": "encounter_id"},
        [F.sum("billing_amount").alias("total_billing_amount"), F.avg("billing_amount").alias("avg_billing_amount")],
    )


def provider_from_files(overview: DataFrame) -> DataFrame:
    """Volume, response and billing per provider over ``overview_from_files``, without NULL groups."""
    keys = {
        "provider_id": "provider_id",
        "provider_name": "provider_name",
        "provider_specialty": "specialty",
        "provider_location": "location",
    }
    shown = [F.col(c).alias(name) for c, name in keys.items()]
    rows = overview.dropna(subset=list(keys)).select(
        *shown, "encounter_id", "patient_id", "treatment_response_score", "billing_amount"
    )
    return aggregate_apart(
        rows,
        list(keys.values()),
        {"encounter_count": "encounter_id", "patient_count": "patient_id"},
        [
            F.avg("treatment_response_score").alias("avg_treatment_response_score"),
            F.sum("billing_amount").alias("total_billing_amount"),
            F.avg("billing_amount").alias("avg_billing_amount"),
        ],
    )
