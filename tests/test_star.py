from datetime import date

import pytest
from pyspark.sql import functions as F

from layerloom.operators import staging
from layerloom.operators.star import (
    assign_providers,
    bridge_encounter_provider,
    dim_date,
    dim_providers,
    fact_encounters,
    keyed_encounters,
    rotate_providers,
    with_date_key,
)
from layerloom.plans import marts
from plans import physical_plan, rows

ENCOUNTERS = (
    "encounter_id string, patient_id string, encounter_date date, treatment string, drug_regimen string, "
    "number_of_cycles int, treatment_response_score decimal(10,2), outcome string"
)


@pytest.fixture(scope="module")
def star(spark):
    day = date(2024, 1, 5)
    encounters = spark.createDataFrame(
        [
            ("e1", "p1", day, "chemo", "r", 1, None, "ok"),
            ("e1", "p1", day, "chemo", "r", 2, None, "ok"),
            ("e2", "p2", date(2024, 2, 6), "radio", "r", 1, None, "ok"),
            ("e3", "p9", day, "chemo", "r", 1, None, "ok"),
            ("e4", None, None, "chemo", "r", 1, None, "ok"),
        ],
        ENCOUNTERS,
    )
    patients = spark.createDataFrame([("p1", 1), ("p2", 2)], "patient_id string, patient_sk bigint")
    catalog = spark.createDataFrame(
        [("p1", "lung", 11), ("p1", "bone", 12), ("p9", "skin", 13)],
        "patient_id string, cancer_type string, cancer_sk bigint",
    )
    billing = spark.createDataFrame(
        [("b2", "e1", 20.0, "x", "Paid"), ("b1", "e1", 10.0, None, "Due"), ("b9", "e9", 99.0, "x", "Paid")],
        "billing_id string, encounter_id string, amount double, insurance string, payment_status string",
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    providers = spark.createDataFrame(
        [("d2", 2, "Bo", "onco", "x"), ("d1", 1, "Al", "onco", "y")],
        "provider_id string, provider_sk bigint, provider_name string, specialty string, location string",
    )
    return encounters, patients, catalog, billing, providers


def test_one_row_per_encounter(star):
    fact = fact_encounters(*star)
    found = {r.encounter_id: r for r in fact.collect()}
    assert fact.count() == len(found) == 4
    e1, e2, e3, e4 = (found[f"e{i}"] for i in (1, 2, 3, 4))
    assert (e1.number_of_cycles, e1.billing_id, e1.patient_sk, e1.cancer_sk) == (1, "b1", 1, 12)
    assert (e1.date_sk, e2.date_sk, e4.date_sk) == (20240105, 20240206, None)
    assert (e2.patient_sk, e2.cancer_sk, e2.billing_id) == (2, None, None)
    # A patient may be in the catalog without being in the dimension.
    assert (e3.patient_sk, e3.cancer_sk) == (None, 13)
    assert (e4.patient_sk, e4.cancer_sk) == (None, None)


def test_all_keeps_every_catalog_and_billing_row(star):
    fact = fact_encounters(*star, cardinality="all")
    assert fact.where("encounter_id = 'e1'").count() == 2 * 2 * 2
    assert fact.count() == 8 + 3
    assert fact.select(F.sum("billing_amount")).first()[0] == 4 * 30


@pytest.mark.parametrize("cardinality", ["one", "all"])
def test_splitting_hot_keys_changes_nothing(star, cardinality):
    plain = fact_encounters(*star, cardinality=cardinality)
    split = fact_encounters(*star, cardinality=cardinality, rows_per_task=1, sample_rate=1.0, broadcast=False)
    assert rows(split) == rows(plain)


@pytest.mark.parametrize("width", [1, 64])
def test_fact_does_not_depend_on_the_shuffle_width(spark, star, width):
    expected = rows(fact_encounters(*star))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    try:
        assert rows(fact_encounters(*star)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_repeated_ids_take_turns_repeatably(spark, star):
    df = spark.createDataFrame([("e1", i) for i in range(6)], "encounter_id string, n int")
    turns = [
        [r.provider_id for r in rotate_providers(df.repartition(k, "n"), star[-1]).orderBy("n").collect()] for k in (1, 3)
    ]
    assert turns == [["d1", "d2"] * 3] * 2


def test_unknown_cardinality(star):
    with pytest.raises(ValueError, match="cardinality"):
        fact_encounters(*star, cardinality="some")


def test_amounts_do_not_grow_in_one_mode(star):
    total = star[3].select(F.sum("amount")).first()[0]
    assert fact_encounters(*star).select(F.sum("billing_amount")).first()[0] <= total


def test_no_providers_leaves_encounters_unassigned(star):
    encounters, *_, providers = star
    none = providers.limit(0)
    for assigned in (assign_providers(encounters, none), rotate_providers(encounters, none)):
        assert assigned.count() == encounters.count()
        assert assigned.where("provider_id IS NOT NULL").count() == 0


def test_every_bridge_row_has_a_provider(star):
    fact = fact_encounters(*star)
    bridge = bridge_encounter_provider(fact)
    assert bridge.count() == 4 and bridge.where("provider_sk IS NULL").count() == 0
    assert bridge_encounter_provider(fact.withColumn("provider_sk", F.lit(None).cast("bigint"))).count() == 0


def test_providers_take_turns(spark, star):
    assigned = rotate_providers(spark.range(5).withColumnRenamed("id", "encounter_id"), star[-1])
    assert [r.provider_id for r in assigned.orderBy("encounter_id").collect()] == ["d1", "d2", "d1", "d2", "d1"]


def test_dim_date_and_lookup(star):
    encounters = star[0].select("encounter_id", "encounter_date")
    dates = dim_date(encounters)
    assert rows(dates, "date_sk") == [
        (20240105, date(2024, 1, 5), 2024, 1, 5, 1),
        (20240206, date(2024, 2, 6), 2024, 2, 6, 1),
    ]
    found = {r.encounter_id: r.date_sk for r in with_date_key(encounters, dates).collect()}
    assert found == {"e1": 20240105, "e2": 20240206, "e3": 20240105, "e4": None}


def test_dim_providers_takes_the_latest_row(spark):
    raw = spark.createDataFrame(
        [("d1", "Al", "a", "x", 3, 1), ("d1", "Al", "b", "x", 4, 2), ("d0", "Zed", "c", "y", None, 1)],
        "provider_id string, provider_name string, specialty string, location string, experience_years int, ts int",
    )
    found = dim_providers(raw, ["ts"]).orderBy("provider_sk").collect()
    assert [(r.provider_sk, r.provider_id, r.specialty) for r in found] == [(1, "d0", "c"), (2, "d1", "b")]


@pytest.fixture(scope="module")
def overview(spark, star):
    encounters, patients, catalog, billing, providers = star
    people = patients.select(
        "*",
        F.concat(F.lit("Name "), "patient_id").alias("patient_name"),
        F.lit("F").alias("gender"),
        F.lit(50).alias("age"),
        F.lit("no").alias("smoking_status"),
    )
    stages = catalog.withColumn("stage", F.lit("II"))
    fact = fact_encounters(*star)
    return marts.encounter_overview(fact, people, stages, providers), fact, people, stages, providers


def test_overview_keeps_fact_rows_that_match_nothing(overview):
    view = overview[0]
    assert view.count() == 4
    e3 = view.where("encounter_id = 'e3'").first()
    assert (e3.patient_id, e3.cancer_type, e3.stage) == (None, "skin", "II")


def test_overview_with_hot_keys_is_the_same(overview):
    view, *tables = overview
    busy = marts.busy_keys(tables[0], rows_per_task=1, sample_rate=1.0)
    assert busy["patient_sk"].where("patient_sk IS NULL").count() == 1
    assert rows(marts.encounter_overview(*tables, busy=busy, broadcast=False)) == rows(view)


def test_overview_broadcasts_small_dimensions_despite_hot_keys(overview):
    _, fact, *dimensions = overview
    tables = [fact, *(staging.write_through(d, "dimension") for d in dimensions)]  # stored, so their sizes are known
    busy = marts.busy_keys(fact, rows_per_task=1, sample_rate=1.0)
    with_hot, without = (physical_plan(marts.encounter_overview(*tables, busy=b)) for b in (busy, None))
    assert with_hot.count("Exchange hashpartitioning") == without.count("Exchange hashpartitioning")


def test_financial_mart_keeps_null_groups(overview):
    mart = marts.financial_analytics(overview[1])
    assert mart.where("insurance IS NULL").count() == 4


def test_provider_mart_groups_before_it_joins(spark, overview):
    _, fact, *_, providers = overview
    mart = marts.provider_performance(fact, providers)
    assert mart.select(F.sum("encounter_count")).first()[0] == 4
    plan = physical_plan(mart)
    assert plan.index("Join [provider_sk") < plan.index("HashAggregate")


def test_overview_deals_rows_without_a_key_over_the_tasks(spark):
    """Most encounters have no catalog row; they used to share the one task of the NULL key."""
    day, n = date(2024, 1, 5), 4000
    ids = spark.range(n).select(F.col("id").alias("encounter_id"), F.col("id").alias("billing_id"))
    absent = F.lit(None).cast("bigint")
    fact = ids.withColumns(
        {
            **{c: F.lit("x") for c in ("treatment", "drug_regimen", "outcome", "insurance", "payment_status", "provider_id")},
            **{c: F.lit(1) for c in ("number_of_cycles", "treatment_response_score", "billing_amount", "patient_id", "date_sk")},
            "encounter_date": F.lit(day),
            "patient_sk": F.when(F.col("encounter_id") < 10, F.col("encounter_id")),
            "cancer_sk": F.when(F.col("encounter_id") < 10, F.col("encounter_id")),
            "provider_sk": absent,
        }
    )
    people = spark.sql("SELECT id AS patient_sk, id AS patient_id, 'n' AS patient_name, 'g' AS gender, 1 AS age, 's' AS smoking_status FROM range(5)")
    cancers = spark.sql("SELECT id AS cancer_sk, 'c' AS cancer_type, 'I' AS stage FROM range(8)")
    doctors = spark.sql("SELECT id AS provider_sk, 'p' AS provider_name, 's' AS specialty, 'l' AS location FROM range(5)")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        view = marts.encounter_overview(fact, people, cancers, doctors)
        per_task = [r["count"] for r in view.groupBy(F.spark_partition_id()).count().collect()]
        found = view.agg(F.count("*"), F.count("patient_name"), F.count("stage"), F.count("provider_name")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [tuple(r) for r in found] == [(n, 5, 8, 0)]
    assert max(per_task) < n / 2


def test_overview_of_every_bill_looks_attributes_up_before_bills(spark, star):
    """The rows equal those over the fact; only the last join holds bills."""
    encounters, patients, catalog, billing, providers = star
    patients = patients.withColumns({"patient_name": F.lit("n"), "gender": F.lit("g"), "age": F.lit(1), "smoking_status": F.lit("s")})
    catalog = catalog.withColumn("stage", F.lit("I"))
    entities = encounters, patients, catalog, billing, providers
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        view = marts.encounter_overview_all(*entities)
        over_fact = marts.encounter_overview(fact_encounters(*entities, cardinality="all"), patients, catalog, providers)
        assert rows(view) == rows(over_fact) and len(rows(view)) == 11
        plan = physical_plan(view)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    joins = [line for line in plan.splitlines() if "Join" in line]
    # The plan is printed from the last join to the first.
    assert "encounter_id" in joins[0] and sum("encounter_id" in j for j in joins) == 1


def test_copies_of_encounters_are_counted_once_for_both_lookups(spark, star):
    """Each lookup used to count them again, over all columns."""
    encounters, patients, catalog, _, providers = star
    copied = encounters.unionByName(encounters.where("encounter_id = 'e1'"))
    limits = {"rows_per_task": 1, "sample_rate": 1.0}
    split = keyed_encounters(copied, patients, catalog, providers, **limits, broadcast=False)
    plain = keyed_encounters(copied, patients, catalog, providers).select(split.columns)
    assert rows(split) == rows(plain) and len(rows(split)) == 11
    counted = [line for line in split._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line and "outcome" in line]
    assert len(counted) == 1
