"""Report filters and the aggregates shown over the filtered overview."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.functions.dates import PRESETS, clamp_window, month_label, preset_start
from layerloom.operators.distinct import distinct_count, stacked
from layerloom.operators.masking import prefix_mask
from layerloom.operators.quality import dq_rows
from layerloom.operators.staging import write_through

TOP_PROVIDERS = 15


@dataclass(frozen=True)
class ReportFilter:
    """An empty list filters nothing. Explicit dates win over the preset."""

    treatments: Sequence[str] = ()
    stages: Sequence[str] = ()
    payment_statuses: Sequence[str] = ()
    preset: str = "All Data"
    start: date | None = None
    end: date | None = None


def date_window(df: DataFrame, preset: str = "All Data", start: date | None = None, end: date | None = None) -> DataFrame:
    """One row: data bounds and the window a preset or a requested range comes to."""
    bounds = df.agg(F.min("encounter_date").alias("min_date"), F.max("encounter_date").alias("max_date"))
    lower, upper = F.col("min_date"), F.col("max_date")
    wanted_start = F.lit(start) if start else preset_start(preset, lower, upper)
    wanted_end = F.lit(end) if end else upper
    first, last = clamp_window(wanted_start, wanted_end, lower, upper)
    return bounds.withColumns({"start_date": first, "end_date": last})


def preset_windows(df: DataFrame) -> DataFrame:
    """One row per preset with the window it comes to, from one pass over the dates."""
    bounds = df.agg(F.min("encounter_date").alias("min_date"), F.max("encounter_date").alias("max_date"))
    lower, upper = F.col("min_date"), F.col("max_date")

    def window(preset: str) -> Column:
        first, last = clamp_window(preset_start(preset, lower, upper), upper, lower, upper)
        return F.struct(F.lit(preset).alias("preset"), first.alias("start_date"), last.alias("end_date"))

    return bounds.select("min_date", "max_date", F.inline(F.array(*[window(p) for p in PRESETS])))


def filter_overview(overview: DataFrame, wanted: ReportFilter, dates: DataFrame | None = None) -> DataFrame:
    """Rows the filter keeps; rows without a date never pass.

    ``dates`` is where the data bounds come from if not the overview itself,
    for example the date dimension, which is far cheaper to scan. An overview
    stored by ``encounter_month`` is read for the months of the window only.
    """
    window = date_window(overview if dates is None else dates, wanted.preset, wanted.start, wanted.end)
    first, last = (window.select(c).scalar() for c in ("start_date", "end_date"))
    keep: Column = F.col("encounter_date").between(first, last)
    if "encounter_month" in overview.columns:
        keep = keep & F.col("encounter_month").between(month_label(first), month_label(last))
    for column, values in (
        ("treatment", wanted.treatments),
        ("stage", wanted.stages),
        ("payment_status", wanted.payment_statuses),
    ):
        if values:
            keep = keep & F.col(column).isin(*values)
    return overview.where(keep)


def filter_values(overview: DataFrame, columns: Sequence[str] = ("treatment", "stage", "payment_status")) -> DataFrame:
    """Sorted distinct non-null values of each filter column, as (filter_name, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("filter_name"), F.col(c).alias("value")) for c in columns])
    return (
        overview.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("filter_name", "value")
    )


def kpi_summary(rows: DataFrame) -> DataFrame:
    """Headline numbers; the zero-filled mean counts missing billing as 0."""
    filled = F.coalesce("billing_amount", F.lit(0))
    return rows.agg(
        F.count_distinct("encounter_id").alias("encounters"),
        F.count_distinct("patient_id").alias("patients"),
        F.coalesce(F.sum("billing_amount"), F.lit(0)).alias("revenue"),
        F.avg("billing_amount").alias("avg_billing"),
        F.avg(filled).alias("avg_billing_zero_filled"),
    )


def monthly_trend(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("encounter_date").isNotNull())
        .groupBy(month_label(F.col("encounter_date")).alias("month"))
        .agg(F.count_distinct("encounter_id").alias("encounter_count"))
        .orderBy("month")
    )


def by_group(rows: DataFrame, group: str, measure: Column, name: str) -> DataFrame:
    """One measure per non-null group value, largest first."""
    return (
        rows.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(measure.alias(name))
        .orderBy(F.desc_nulls_last(name), group)
    )


def treatment_mix(rows: DataFrame) -> DataFrame:
    return by_group(rows, "treatment", F.count_distinct("encounter_id"), "encounter_count")


def stage_distribution(rows: DataFrame) -> DataFrame:
    return by_group(rows, "stage", F.count_distinct("patient_id"), "patient_count")


def response_by_treatment(rows: DataFrame) -> DataFrame:
    return by_group(rows, "treatment", F.avg("treatment_response_score"), "treatment_response_score")


def _revenue() -> Column:
    return F.coalesce(F.sum("billing_amount"), F.lit(0))


def revenue_by_payer(rows: DataFrame) -> DataFrame:
    return by_group(rows, "insurance", _revenue(), "billing_amount")


def payment_status_mix(rows: DataFrame) -> DataFrame:
    return by_group(rows, "payment_status", _revenue(), "billing_amount")


def top_providers(performance: DataFrame, measure: str, n: int = TOP_PROVIDERS) -> DataFrame:
    """The ``n`` providers with the highest measure, ties by provider_id."""
    return performance.orderBy(F.desc_nulls_last(measure), "provider_id").limit(n)


def governance_slice(rows: DataFrame) -> DataFrame:
    """Patient columns with the id masked and the amount renamed."""
    return rows.select(
        "patient_name",
        "gender",
        "age",
        "smoking_status",
        "cancer_type",
        "stage",
        "treatment",
        F.col("billing_amount").alias("amount"),
        prefix_mask(F.col("patient_id")).alias("patient_id_masked"),
    )


# The grouped reports and the column each is grouped by.
GROUPED_REPORTS = {
    "monthly_trend": "month",
    "treatment_mix": "treatment",
    "stage_distribution": "stage",
    "revenue_by_payer": "insurance",
    "payment_status_mix": "payment_status",
}
#: What the bundle calls the row over everything.
OVERALL = "overall"


def report_bundle(rows: DataFrame) -> DataFrame:
    """Every measure overall and per value of each report's group; stored, as are the columns of ``rows`` it needs.

    ``rows`` is worked out once and its stored columns are read once per count. Sums come from one aggregation over grouping sets, each distinct count from one of its own.
    ``grouping_id`` says which set a row is of: a bit for each group that it isn't grouped by.
    """
    groups = list(GROUPED_REPORTS.values())
    labelled = rows.withColumn("month", month_label(F.col("encounter_date")))
    ids = {"encounter_count": "encounter_id", "patient_count": "patient_id"}
    labelled = write_through(
        labelled.select(*groups, *ids.values(), "encounter_date", "billing_amount", "treatment_response_score"), "report-rows"
    )
    amount = F.col("billing_amount")
    totals = labelled.groupingSets([[], *[[F.col(g)] for g in groups]], *groups).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("row_count"),
        _revenue().alias("revenue"),
        F.avg(amount).alias("avg_billing"),
        F.avg(F.coalesce(amount, F.lit(0))).alias("avg_billing_zero_filled"),
        F.avg("treatment_response_score").alias("avg_treatment_response_score"),
        F.count_if(amount.isNull()).alias("missing_amounts"),
        F.count_if(F.col("encounter_date").isNull()).alias("missing_dates"),
        F.coalesce(F.max(F.col("encounter_id").isNull().cast("bigint")), F.lit(0)).alias("missing_ids"),
    )
    everything = 2 ** len(groups) - 1
    name, value = F.when(F.col("_set") == everything, F.lit(OVERALL)), F.lit(None).cast("string")
    for i, (report_name, group) in enumerate(GROUPED_REPORTS.items()):
        own = F.col("_set") == everything - 2 ** (len(groups) - 1 - i)
        name, value = name.when(own, F.lit(report_name)), F.when(own, F.col(group)).otherwise(value)
    measures = totals.columns[len(groups) + 1 :]
    named = totals.select(name.alias("report"), value.alias("group_value"), *measures)
    named = named.where((F.col("report") == OVERALL) | F.col("group_value").isNotNull())
    # without rows there are no sets, so the overall row of nothing stands by
    nothing = rows.sparkSession.range(1).select(
        F.lit(OVERALL).alias("report"),
        F.lit(None).cast("string").alias("group_value"),
        *[F.lit(None if m.startswith("avg") else 0).cast(named.schema[m].dataType).alias(m) for m in measures],
    )

    def counted(count: str, report_name: str, group: str | None) -> DataFrame:
        of = labelled if group is None else labelled.where(F.col(group).isNotNull())
        found = distinct_count(of, [] if group is None else [group], ids[count], count)
        value = F.lit(None) if group is None else F.col(group)
        return found.select(F.lit(report_name).alias("report"), value.cast("string").alias("group_value"), count)

    asked = {OVERALL: None, **GROUPED_REPORTS}
    counts = {count: [counted(count, *of) for of in asked.items()] for count in ids}
    bundle = stacked(named.unionByName(nothing), ["report", "group_value"], "row_count", counts)
    return write_through(bundle.select("report", "group_value", "row_count", *ids, *measures[1:]), "report-bundle")


def from_bundle(bundle: DataFrame) -> dict[str, DataFrame]:
    """The single reports out of a stored bundle, which has a row per group value."""

    def grouped(name: str, group: str, measure: str, shown: str) -> DataFrame:
        return bundle.where(F.col("report") == name).select(F.col("group_value").alias(group), F.col(measure).alias(shown))

    def largest_first(name: str, measure: str, shown: str) -> DataFrame:
        group = GROUPED_REPORTS[name]
        return grouped(name, group, measure, shown).orderBy(F.desc_nulls_last(shown), group)

    overall = bundle.where(F.col("report") == OVERALL)
    by_treatment = grouped("treatment_mix", "treatment", "avg_treatment_response_score", "treatment_response_score")
    return {
        "kpi_summary": overall.select(
            F.col("encounter_count").alias("encounters"),
            F.col("patient_count").alias("patients"),
            "revenue",
            "avg_billing",
            "avg_billing_zero_filled",
        ),
        "monthly_trend": grouped("monthly_trend", "month", "encounter_count", "encounter_count").orderBy("month"),
        "treatment_mix": largest_first("treatment_mix", "encounter_count", "encounter_count"),
        "stage_distribution": largest_first("stage_distribution", "patient_count", "patient_count"),
        "response_by_treatment": by_treatment.orderBy(F.desc_nulls_last("treatment_response_score"), "treatment"),
        "revenue_by_payer": largest_first("revenue_by_payer", "revenue", "billing_amount"),
        "payment_status_mix": largest_first("payment_status_mix", "revenue", "billing_amount"),
        "dq_summary": dq_rows(
            overall.select(
                F.col("row_count").alias("n"),
                F.col("missing_amounts").alias("no_amount"),
                F.col("missing_dates").alias("no_day"),
                F.col("encounter_count").alias("keys"),
                F.col("missing_ids").alias("unkeyed"),
            )
        ),
    }


def report(
    overview: DataFrame, performance: DataFrame, wanted: ReportFilter = ReportFilter(), dates: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every report over one filter.

    The aggregates come from one stored bundle, so the overview is read once for
    all of them; only the slice of rows reads it again.
    """
    rows = filter_overview(overview, wanted, dates)
    return {
        **from_bundle(report_bundle(rows)),
        "top_providers_by_encounters": top_providers(performance, "encounter_count"),
        "top_providers_by_response": top_providers(performance, "avg_treatment_response_score"),
        "governance_slice": governance_slice(rows),
    }
