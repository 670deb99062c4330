from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerloom.operators.masking import PATIENT_POLICIES, MaskPolicy, apply_masks, pattern_mask
from layerloom.operators.quality import dq_summary
from layerloom.plans import reports
from layerloom.plans.metrics import ENCOUNTER_METRICS, PROVIDER_METRICS, stored_query
from layerloom.plans.reports import ReportFilter, filter_overview
from plans import physical_plan, rows

OVERVIEW = (
    "encounter_id int, patient_id string, patient_name string, gender string, age int, smoking_status string, "
    "cancer_type string, stage string, treatment string, encounter_date date, treatment_response_score double, "
    "billing_amount decimal(18,2), insurance string, payment_status string"
)


@pytest.fixture(scope="module")
def overview(spark):
    def row(i, patient, stage, treatment, day, score, amount, payer, status):
        money = None if amount is None else Decimal(amount)
        return (i, patient, f"Name {patient}", "F", 40, "no", "lung", stage, treatment, day, score, money, payer, status)

    return spark.createDataFrame(
        [
            row(1, "pat-1", "I", "chemo", date(2024, 1, 31), 5.0, None, None, "Due"),
            row(2, "pat-1", "I", "chemo", date(2024, 2, 29), 7.0, 10, "A", "Paid"),
            row(3, "pat-2", None, "radio", date(2024, 3, 31), None, 30, "A", "Paid"),
            row(4, "p3", "II", None, None, 1.0, 5, "B", None),
        ],
        OVERVIEW,
    )


def ids(df):
    return sorted(r.encounter_id for r in df.collect())


def test_empty_filter_drops_only_rows_without_a_date(overview):
    assert ids(filter_overview(overview, ReportFilter())) == [1, 2, 3]


def test_a_chosen_value_drops_nulls(overview):
    assert ids(filter_overview(overview, ReportFilter(stages=["I", "II"]))) == [1, 2]
    assert ids(filter_overview(overview, ReportFilter(treatments=["radio"], payment_statuses=["Paid"]))) == [3]


def test_preset_and_inclusive_bounds(overview):
    assert ids(filter_overview(overview, ReportFilter(preset="Past Month"))) == [2, 3]
    wanted = ReportFilter(start=date(2024, 1, 31), end=date(2024, 2, 29))
    assert ids(filter_overview(overview, wanted)) == [1, 2]


def test_filters_reach_the_scan(spark, overview, tmp_path):
    overview.write.parquet(str(tmp_path / "overview"))
    stored = spark.read.parquet(str(tmp_path / "overview"))
    report = reports.treatment_mix(filter_overview(stored, ReportFilter(stages=["I"])))
    plan = physical_plan(report)
    assert "EqualTo(stage,I)" in plan and "IsNotNull(encounter_date)" in plan
    assert "patient_name" not in plan


def test_kpi_has_both_averages(overview):
    found = reports.kpi_summary(overview).first()
    assert (found.encounters, found.patients, float(found.revenue)) == (4, 3, 45.0)
    assert (float(found.avg_billing), float(found.avg_billing_zero_filled)) == (15.0, 11.25)
    assert float(reports.kpi_summary(overview.limit(0)).first().revenue) == 0


def test_group_reports_drop_null_groups(overview):
    assert rows(reports.treatment_mix(overview)) == [("chemo", 2), ("radio", 1)]
    assert rows(reports.stage_distribution(overview)) == [("I", 1), ("II", 1)]
    assert [tuple(r) for r in reports.response_by_treatment(overview).collect()] == [("chemo", 6.0), ("radio", None)]
    assert [(r[0], float(r[1])) for r in reports.revenue_by_payer(overview).collect()] == [("A", 40.0), ("B", 5.0)]
    assert [(r[0], float(r[1])) for r in reports.payment_status_mix(overview).collect()] == [("Paid", 40.0), ("Due", 0.0)]
    assert rows(reports.monthly_trend(overview)) == [("2024-01", 1), ("2024-02", 1), ("2024-03", 1)]


def test_filter_values(overview):
    assert [tuple(r) for r in reports.filter_values(overview).collect()] == [
        ("payment_status", "Due"),
        ("payment_status", "Paid"),
        ("stage", "I"),
        ("stage", "II"),
        ("treatment", "chemo"),
        ("treatment", "radio"),
    ]


def test_top_providers_break_ties_and_avoid_a_full_sort(spark):
    performance = spark.createDataFrame([(i, 1 if i else None) for i in range(20)], "provider_id int, encounter_count int")
    top = reports.top_providers(performance, "encounter_count")
    assert [r.provider_id for r in top.collect()] == list(range(1, 16))
    assert "TakeOrderedAndProject" in physical_plan(top)


def test_report_bundle(spark, overview):
    performance = spark.createDataFrame([(1, 2, 3.0)], "provider_id int, encounter_count int, avg_treatment_response_score double")
    bundle = reports.report(overview, performance, ReportFilter(stages=["I"]))
    assert len(bundle) == 11
    assert bundle["kpi_summary"].first().encounters == 2
    assert {r.check_name: r.rows for r in bundle["dq_summary"].collect()}["Missing encounter date"] == 0


def test_reports_out_of_the_bundle_equal_single_ones(overview):
    for given in (overview, overview.where("stage = 'I'"), overview.limit(0)):
        found = reports.from_bundle(reports.report_bundle(given))
        for name, one in found.items():
            if name != "dq_summary":
                want = getattr(reports, name)(given)
                assert [tuple(r) for r in one.collect()] == [tuple(r) for r in want.collect()], name
                assert one.columns == want.columns
        want = reports_dq(given)
        assert rows(found["dq_summary"]) == rows(want)


def reports_dq(given):
    return dq_summary(given, amount="billing_amount", day="encounter_date", key="encounter_id")


def test_the_bundle_reads_its_rows_once(spark, overview, tmp_path):
    overview.write.parquet(str(tmp_path / "overview"))
    plan = physical_plan(reports.report_bundle(spark.read.parquet(str(tmp_path / "overview"))))
    assert plan.split("== Initial Plan ==")[-1].count("FileScan") == 1 and "patient_name" not in plan


def test_governance_slice_hides_the_id(overview):
    sliced = reports.governance_slice(overview)
    assert "patient_id" not in sliced.columns and "amount" in sliced.columns
    assert {r.patient_id_masked for r in sliced.collect()} == {"pat****", "p3****"}


def test_masks_depend_on_the_role(spark):
    df = spark.createDataFrame([("AB", "Ann"), ("ABCDE", None), (None, "Bo")], "patient_id string, patient_name string")
    assert rows(apply_masks(df, PATIENT_POLICIES, "admin")) == rows(df)
    assert rows(apply_masks(df, PATIENT_POLICIES, "analyst")) == [("AB****", "REDACTED"), ("ABC****", "REDACTED"), (None, "REDACTED")]
    short = apply_masks(df, [MaskPolicy("patient_id", pattern_mask)], "analyst")
    assert rows(short) == [("AB", "Ann"), ("ABC****", None), (None, "Bo")]
    assert apply_masks(df.drop("patient_name"), PATIENT_POLICIES, "analyst").columns == ["patient_id"]


def test_metric_view(overview):
    grouped = ENCOUNTER_METRICS.query(overview, ["cancer_stage"], ["encounter_count"], where="billing_amount > 5")
    assert rows(grouped) == [("I", 1), (None, 1)]
    assert ENCOUNTER_METRICS.query(overview, measures=["total_billing_amount"]).count() == 1
    with pytest.raises(KeyError, match="nothing"):
        PROVIDER_METRICS.query(overview, ["nothing"], ["encounter_count"])
    with pytest.raises(ValueError, match="at least one measure"):
        ENCOUNTER_METRICS.query(overview, ["treatment"])


def test_stored_query_orders_nulls_last(spark, overview):
    found = stored_query("stage_revenue", encounter_overview=overview.withColumn("provider_id", F.lit(1)))
    assert [r.stage for r in found.collect()] == [None, "I", "II"]
