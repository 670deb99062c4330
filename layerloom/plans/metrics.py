"""Declared metrics: named dimensions and measures over a relation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class MetricView:
    """SQL expressions by name; a query picks some of each."""

    name: str
    dimensions: dict[str, str]
    measures: dict[str, str]

    def query(
        self,
        relation: DataFrame,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] = (),
        where: str | None = None,
    ) -> DataFrame:
        """Group ``relation`` by the dimensions; without any, one row for the whole."""
        unknown = [d for d in dimensions if d not in self.dimensions]
        unknown += [m for m in measures if m not in self.measures]
        if unknown:
            raise KeyError(f"{self.name} does not declare {unknown}")
        if not measures:
            raise ValueError("name at least one measure")
        rows = relation if where is None else relation.where(where)
        return rows.groupBy(*[F.expr(self.dimensions[d]).alias(d) for d in dimensions]).agg(
            *[F.expr(self.measures[m]).alias(m) for m in measures]
        )


# The declared dimensions and measures of the two marts.
ENCOUNTER_METRICS = MetricView(
    "encounter_overview",
    dimensions={
        "encounter_id": "encounter_id",
        "encounter_date": "encounter_date",
        "treatment": "treatment",
        "drug_regimen": "drug_regimen",
        "outcome": "outcome",
        "insurance": "insurance",
        "provider_id": "provider_id",
        "provider_name": "provider_name",
        "provider_specialty": "provider_specialty",
        "payment_status": "payment_status",
        "patient_gender": "gender",
        "cancer_type": "cancer_type",
        "cancer_stage": "stage",
    },
    measures={
        "encounter_count": "count(DISTINCT encounter_id)",
        "total_billing_amount": "sum(billing_amount)",
        "avg_billing_amount": "avg(billing_amount)",
    },
)

PROVIDER_METRICS = MetricView(
    "provider_performance",
    dimensions={
        "provider_id": "provider_id",
        "provider_name": "provider_name",
        "specialty": "specialty",
        "location": "location",
    },
    measures={
        "encounter_count": "sum(encounter_count)",
        "patient_count": "sum(patient_count)",
        "avg_treatment_response_score": "avg(avg_treatment_response_score)",
        "total_billing_amount": "sum(total_billing_amount)",
    },
)

# The provider measures above add up distinct counts and average averages.
# These take the same questions back to the encounter rows.
PROVIDER_METRICS_EXACT = MetricView(
    "provider_performance_exact",
    dimensions={
        "provider_id": "provider_id",
        "provider_name": "provider_name",
        "specialty": "provider_specialty",
        "location": "provider_location",
    },
    measures={
        "encounter_count": "count(DISTINCT encounter_id)",
        "patient_count": "count(DISTINCT patient_id)",
        "avg_treatment_response_score": "avg(treatment_response_score)",
        "total_billing_amount": "sum(billing_amount)",
    },
)


def _monthly_encounters(encounter_overview: DataFrame) -> DataFrame:
    months = encounter_overview.withColumn("month_start", F.trunc("encounter_date", "MM"))
    by_month = replace(ENCOUNTER_METRICS, dimensions={"month_start": "month_start"})
    return by_month.query(months, ["month_start"], ["encounter_count"]).orderBy("month_start")


def _stage_revenue(encounter_overview: DataFrame) -> DataFrame:
    by_stage = ENCOUNTER_METRICS.query(encounter_overview, ["cancer_stage"], ["total_billing_amount"])
    named = by_stage.withColumnsRenamed({"cancer_stage": "stage", "total_billing_amount": "total_revenue"})
    return named.orderBy(F.desc_nulls_last("total_revenue"), "stage")


def _provider_ranking(provider_performance: DataFrame) -> DataFrame:
    shown = provider_performance.select("provider_name", "specialty", "encounter_count", "total_billing_amount")
    return shown.orderBy(F.desc_nulls_last("encounter_count"), F.desc_nulls_last("total_billing_amount"), "provider_name")


#: Stored questions over the marts, each with a total order; arguments are named after the mart they ask.
STORED_QUERIES = {
    "monthly_encounters": _monthly_encounters,
    "stage_revenue": _stage_revenue,
    "provider_ranking": _provider_ranking,
}


def stored_query(name: str, **marts: DataFrame) -> DataFrame:
    """Ask a stored question of the mart it is about."""
    return STORED_QUERIES[name](**marts)
