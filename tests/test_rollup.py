"""Rolled-up distinct counts and the factorised marts against the rows they stand for."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerloom.operators import quality, star
from layerloom.plans import factorised, marts, reports, rollup
from plans import physical_plan, rows


@pytest.fixture(scope="module")
def overview(spark):
    rng = random.Random(11)
    data = []
    for i in range(900):
        data.append((
            None if i % 90 == 0 else i % 700, rng.choice([None, *range(40)]), rng.choice(["x", "y", None]), rng.choice(["I", "II", None]),
            rng.choice(["due", "paid"]), rng.choice(["s1", "s2", None]), None if i % 50 == 0 else date(2024, 1, 1) + timedelta(days=i % 120),
            None if i % 7 == 0 else Decimal(rng.randrange(-500, 9000)) / 100, None if i % 5 == 0 else Decimal(rng.randrange(0, 900)) / 100, "A",
        ))
    return spark.createDataFrame(
        data,
        "encounter_id bigint, patient_id bigint, treatment string, stage string, payment_status string, "
        "provider_specialty string, encounter_date date, billing_amount decimal(18,2), "
        "treatment_response_score decimal(18,2), insurance string",
    )


@pytest.mark.parametrize("by", [[], ["treatment"], ["encounter_month", "stage"], list(rollup.GROUPS)])
def test_rollup_equals_the_rows(overview, by):
    built = rollup.build_rollup(overview)
    found = rollup.roll_up(built, by)
    labelled = overview.withColumn("encounter_month", F.date_format("encounter_date", "yyyy-MM"))
    want = labelled.groupBy(*by).agg(
        F.count_distinct("encounter_id"),
        F.count_distinct("patient_id"),
        F.sum("billing_amount"),
        F.avg("billing_amount"),
        F.avg(F.coalesce("billing_amount", F.lit(0))),
        F.avg("treatment_response_score"),
    )
    zero = {None: Decimal(0)}
    fix = lambda found: sorted([(*t[: len(by) + 4], zero.get(t[len(by) + 4], t[len(by) + 4]), t[-1]) for t in map(tuple, found.collect())], key=repr)
    assert fix(found) == fix(want)
    assert "Expand" not in physical_plan(found)
    with pytest.raises(KeyError, match="city"):
        rollup.roll_up(built, ["city"])


def test_each_bitmap_is_made_once_from_different_ids(spark, overview, monkeypatch):
    """Every task used to send a bitmap of its own for the few ids it had of a group."""
    plans = {}
    write = rollup.write_through
    monkeypatch.setattr(rollup, "write_through", lambda df, label: (plans.update({label: df}), write(df, label))[1])
    rollup.build_rollup(overview.unionByName(overview))
    plan = physical_plan(plans["rollup-bitmaps"])
    made = [line.index("SortAggregate") for line in plan.splitlines() if "bitmap_construct_agg" in line]
    between = plan[plan.index("bitmap_construct_agg"):plan.index("partial_bitmap_construct_agg")]
    assert len(made) == 4 and "Exchange" not in between


def test_kpi_and_empty_rollup(overview):
    for given in (overview, overview.where("treatment = 'x'"), overview.limit(0)):
        assert rows(rollup.kpi_from_rollup(rollup.build_rollup(given))) == rows(reports.kpi_summary(given))


@pytest.fixture(scope="module")
def entities(spark):
    rng = random.Random(2)
    day = lambda i: None if i % 11 == 0 else date(2024, 1, 1 + i % 9)
    money = lambda n: None if n % 6 == 0 else Decimal(n) / 100
    encounters = [(i, None if i % 13 == 0 else i % 30, day(i), "t%d" % (i % 3), "d", 1, money(i * 7), "o") for i in range(120)]
    catalog = [(p, f"c{n}", "I") for p in range(0, 25) for n in range(1 + (p == 4) * 60 + p % 3)] + [(None, "c", "I")]
    bills = [(n, rng.randrange(0, 100), money(n), "i%d" % (n % 2), "p%d" % (n % 3)) for n in range(300)]
    bills += [(1000 + n, 4, money(n), "i0", "p0") for n in range(80)] + [(5000, None, Decimal(1), "i0", "p0")]
    doctors = [(f"d{n}", f"name {n}", f"s{n % 2}", "l", n) for n in range(5)]
    make = spark.createDataFrame
    return (
        make(encounters, "encounter_id int, patient_id int, encounter_date date, treatment string, drug_regimen string, "
             "number_of_cycles int, treatment_response_score decimal(18,2), outcome string"),
        make(catalog, "patient_id int, cancer_type string, stage string").withColumn("cancer_sk", F.expr("xxhash64(patient_id, cancer_type)")),
        make(bills, "billing_id int, encounter_id int, amount decimal(18,2), insurance string, payment_status string"),
        star.dim_providers(make(doctors, "provider_id string, provider_name string, specialty string, location string, experience_years int")),
    )


def test_factorised_marts_equal_those_over_the_product(spark, entities):
    encounters, catalog, billing, providers = entities
    people = spark.range(40).select(F.col("id").cast("int").alias("patient_id"), F.col("id").alias("patient_sk"))
    fact = star.fact_encounters(encounters, people, catalog, billing, providers, cardinality="all")
    assert rows(factorised.financial_analytics_all(encounters, catalog, billing)) == rows(marts.financial_analytics(fact))
    assert rows(factorised.provider_performance_all(encounters, catalog, billing, providers)) == rows(
        marts.provider_performance(fact, providers)
    )
    want = quality.dq_summary(fact, amount="billing_amount", day="encounter_date", key="encounter_id")
    assert rows(factorised.dq_summary_all(encounters, catalog, billing)) == rows(want)
    assert fact.count() > 5000  # a patient with 62 catalog rows has an encounter with 80 bills


def test_factorised_plans_join_unique_rows_only(spark, entities):
    encounters, catalog, billing, _ = entities
    held = factorised.weighted_encounters(encounters, catalog)
    assert held.count() == encounters.count()
    assert factorised._with_bills(encounters, catalog, billing).count() == encounters.count()
    empty = factorised.dq_summary_all(encounters.limit(0), catalog, billing)
    assert [r.rows for r in empty.collect()] == [0, 0, 0]
