"""Dimensions without history, the encounter fact and the provider bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.dates import date_key
from layerloom.functions.hashing import stable_bucket
from layerloom.operators.dedupe import first_per_key, latest_per_key
from layerloom.operators.keys import dense_key
from layerloom.operators.skew import ROWS_PER_TASK, SAMPLE_RATE, fits_broadcast, hot_keys, left_join

# Fixed value: how the bridge names the assignment.
ASSIGNMENT_METHOD = "HASH_ENCOUNTER_PROVIDER_ASSIGNMENT"


def dim_date(encounters: DataFrame) -> DataFrame:
    """One row per date seen."""
    day = F.col("encounter_date")
    return (
        encounters.select("encounter_date")
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_sk"),
            "encounter_date",
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"),
            F.quarter(day).alias("quarter"),
        )
    )


def dim_providers(providers: DataFrame, recency: Sequence[str] = ()) -> DataFrame:
    """Latest row per provider, keyed 1..n over provider_id; rebuilt with the fact."""
    latest = latest_per_key(providers, ["provider_id"], recency).select(
        "provider_id", "provider_name", "specialty", "location", "experience_years"
    )
    return dense_key(latest, ["provider_id"], "provider_sk")


def with_date_key(encounters: DataFrame, dates: DataFrame) -> DataFrame:
    """Look the date key up in the dimension; NULL where the date is NULL or not in it."""
    return encounters.join(dates.select("encounter_date", "date_sk"), "encounter_date", "left")


def _with_provider_at(df: DataFrame, providers: DataFrame, slot) -> DataFrame:
    """Join each row to the provider whose zero-based rank over provider_id is ``slot``."""
    ranked = dense_key(
        providers.select("provider_id", "provider_sk"), ["provider_id"], "_slot", base=F.lit(-1).cast("bigint")
    )
    return df.withColumn("_slot", slot).join(ranked, "_slot", "left").drop("_slot")


def assign_providers(encounters: DataFrame, providers: DataFrame) -> DataFrame:
    """Give every encounter a provider by a stable hash of its id; NULL if there are none."""
    total = providers.agg(F.count(F.lit(1))).scalar()
    return _with_provider_at(encounters, providers, stable_bucket(F.col("encounter_id"), total))


def rotate_providers(
    encounters: DataFrame,
    providers: DataFrame,
    order: Sequence[str] = ("encounter_id",),
) -> DataFrame:
    """Give encounters providers in turn, by position in a stated order.

    Every other column breaks ties, so repeated ids are numbered the same way each time.
    """
    total = providers.agg(F.count(F.lit(1))).scalar()
    full_order = [*order, *[c for c in encounters.columns if c not in order]]
    numbered = dense_key(encounters, full_order, "_row", base=F.lit(-1).cast("bigint"))
    slot = F.pmod(F.col("_row"), F.nullif(total, F.lit(0).cast("bigint")))
    return _with_provider_at(numbered, providers, slot).drop("_row")


# The columns of the fact.
FACT_COLUMNS = (
    "encounter_id",
    "patient_sk",
    "cancer_sk",
    "provider_sk",
    "provider_id",
    "date_sk",
    "patient_id",
    "encounter_date",
    "treatment",
    "drug_regimen",
    "number_of_cycles",
    "treatment_response_score",
    "outcome",
    "billing_id",
    "billing_amount",
    "insurance",
    "payment_status",
)


def fact_encounters(
    encounters: DataFrame,
    patients: DataFrame,
    catalog: DataFrame,
    billing: DataFrame,
    providers: DataFrame,
    *,
    cardinality: str = "one",
    rows_per_task: int = ROWS_PER_TASK,
    sample_rate: float = SAMPLE_RATE,
    broadcast: bool = True,
) -> DataFrame:
    """Encounters with their dimension keys and billing; misses stay NULL.

    ``"one"`` gives one row per encounter: the lowest cancer type of the patient
    and the lowest billing row by a total order. ``"all"`` keeps every current
    catalog row and every billing row, so amounts repeat.

    ``patients`` and ``catalog`` hold current versions. Keys are looked up on the
    encounters, before billing repeats them: a patient is hot by its number of
    encounters there, and an encounter with very many bills splits by itself.
    ``broadcast=False`` splits hot keys also where a side is small.
    """
    if cardinality not in ("one", "all"):
        raise ValueError(f"cardinality must be 'one' or 'all', not {cardinality!r}")
    limits = {"rows_per_task": rows_per_task, "sample_rate": sample_rate}
    if cardinality == "one":
        busy_patients = hot_keys(encounters, ["patient_id"], **limits)
        rows = first_per_key(encounters, ["encounter_id"]).join(
            first_per_key(_bills(billing), ["encounter_id"], ["billing_id"]), "encounter_id", "left"
        )
        cancers = catalog.select("patient_id", "cancer_type", "cancer_sk")
        cancers = first_per_key(cancers, ["patient_id"], ["cancer_type"]).drop("cancer_type")
        # Both sides are unique per patient, so one lookup table serves both keys.
        lookup = patients.select("patient_id", "patient_sk").join(cancers, "patient_id", "full_outer")
        rows = left_join(rows, lookup, ["patient_id"], left_hot=busy_patients, left_distinct=True, broadcast=broadcast)
        rows = assign_providers(rows, providers)
    else:
        rows = keyed_encounters(encounters, patients, catalog, providers, **limits, broadcast=broadcast)
        rows = with_every_bill(rows, billing, **limits, broadcast=broadcast)
    return rows.withColumn("date_sk", date_key(F.col("encounter_date"))).select(*FACT_COLUMNS)


def _bills(billing: DataFrame) -> DataFrame:
    return billing.select(
        "encounter_id", "billing_id", F.col("amount").alias("billing_amount"), "insurance", "payment_status"
    )


def keyed_encounters(
    encounters: DataFrame,
    patients: DataFrame,
    catalog: DataFrame,
    providers: DataFrame,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    sample_rate: float = SAMPLE_RATE,
    broadcast: bool = True,
) -> DataFrame:
    """The ``"all"`` fact before its bills: every encounter with its keys, once per current catalog row.

    Where lookups are split, exact copies of an encounter are counted once for both and written out after them;
    bills, which match by encounter, would bring them together in any case.
    """
    limits = {"rows_per_task": rows_per_task, "sample_rate": sample_rate}
    busy_patients = hot_keys(encounters, ["patient_id"], **limits)
    people = patients.select("patient_id", "patient_sk")
    cancers = catalog.select("patient_id", "cancer_sk")
    split = busy_patients is not None and not (broadcast and fits_broadcast(people))
    of_left = {"left_hot": busy_patients, "left_distinct": split, "broadcast": broadcast}
    rows = encounters.groupBy(*encounters.columns).agg(F.count(F.lit(1)).alias("_copies")) if split else encounters
    rows = left_join(rows, people, ["patient_id"], **of_left)
    rows = assign_providers(rows, providers)
    rows = left_join(
        rows, cancers, ["patient_id"], right_hot=hot_keys(cancers, ["patient_id"], **limits), **of_left
    )
    if not split:
        return rows
    return rows.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).drop("_copies")


def with_every_bill(
    rows: DataFrame,
    billing: DataFrame,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    sample_rate: float = SAMPLE_RATE,
    broadcast: bool = True,
) -> DataFrame:
    """``rows`` once per bill of their encounter, and once without one where there is none."""
    bills = _bills(billing)
    busy_encounters = hot_keys(bills, ["encounter_id"], rows_per_task=rows_per_task, sample_rate=sample_rate)
    return left_join(rows, bills, ["encounter_id"], right_hot=busy_encounters, broadcast=broadcast)


def bridge_encounter_provider(fact: DataFrame) -> DataFrame:
    """Encounter-provider pairs of the fact."""
    return fact.where(F.col("provider_sk").isNotNull()).select(
        "encounter_id", "provider_sk", "provider_id", F.lit(ASSIGNMENT_METHOD).alias("assignment_method")
    )
