"""Distinct counts worked out apart, against Spark's own over the same rows."""

import re
from datetime import date

from pyspark.sql import functions as F

from layerloom.operators.distinct import aggregate_apart
from layerloom.plans import factorised, marts, reports
from plans import physical_plan, rows

DAY = date(2024, 1, 5)


def _odd(spark):
    """Repeated rows, NULL groups, NULL ids and a group without any id."""
    listed = [("a", 1, 1, 2.0), ("a", 1, 2, None), ("a", None, 2, 2.0), (None, 3, None, 1.0), (None, 3, 4, 1.0), ("z", None, None, None)]
    odd = spark.createDataFrame(listed * 2, "g string, encounter_id int, patient_id int, amount double")
    return odd.withColumn("amount", F.col("amount").cast("decimal(18,2)"))


def test_counts_apart_are_those_of_one_aggregation(spark):
    odd, ids = _odd(spark), {"encounters": "encounter_id", "patients": "patient_id"}
    measures = [F.sum("amount").alias("total"), F.avg("amount").alias("mean")]
    apart = aggregate_apart(odd, ["g"], ids, measures)
    at_once = odd.groupBy("g").agg(*[F.count_distinct(c).alias(n) for n, c in ids.items()], *measures)
    assert rows(apart) == rows(at_once) and dict(apart.dtypes) == dict(at_once.dtypes)
    assert apart.columns == at_once.columns
    assert rows(aggregate_apart(odd.where("false"), ["g"], ids, measures)) == []


def _overview(spark):
    odd = _odd(spark).withColumnRenamed("amount", "billing_amount")
    names = {c: F.col("g") for c in ("treatment", "stage", "insurance", "payment_status", "provider_id")}
    named = {c: F.lit("n") for c in ("provider_name", "provider_specialty", "provider_location")}
    score = F.lit(1).cast("decimal(18,2)")
    return odd.withColumns({**names, **named, "encounter_date": F.lit(DAY), "treatment_response_score": score})


def test_marts_from_files_hold_one_kind_of_id_per_task(spark):
    plan = physical_plan(marts.provider_from_files(_overview(spark)))
    assert "Expand" not in plan  # which repeats each row once per distinct column
    keys = r"keys=\[encounter_date#\d+, treatment#\d+, insurance#\d+, payment_status#\d+, encounter_id#\d+L?\], functions=\[(partial_|merge_)"
    assert not re.search(keys, physical_plan(marts.financial_from_files(_overview(spark))))
    found = marts.provider_from_files(_overview(spark)).select("provider_id", "encounter_count", "patient_count")
    assert rows(found) == [("a", 1, 2), ("z", 0, 0)]


def test_the_bundle_counts_each_set_apart(spark, monkeypatch):
    stored, write = [], reports.write_through
    monkeypatch.setattr(reports, "write_through", lambda df, label: stored.append(physical_plan(df)) or write(df, label))
    bundle = reports.report_bundle(_overview(spark))
    assert len(stored) == 2 and all(not re.search(r"\bgid#", plan) for plan in stored)
    found = {(r.report, r.group_value): (r.row_count, r.encounter_count, r.patient_count) for r in bundle.collect()}
    assert found["overall", None] == (12, 2, 3)
    assert found["treatment_mix", "a"] == (6, 1, 2) and found["treatment_mix", "z"] == (2, 0, 0)


def test_encounters_of_the_all_mode_are_counted_without_a_set_of_ids(spark):
    visits = spark.createDataFrame(
        [(1, "p", DAY, "t"), (1, "p", DAY, "t"), (1, "q", None, "t"), (2, "p", DAY, "t"), (None, "p", DAY, "t")],
        "encounter_id bigint, patient_id string, encounter_date date, treatment string",
    )
    cancers = spark.createDataFrame([("p", "x"), ("p", "y")], "patient_id string, cancer_type string")
    bills = spark.createDataFrame(
        [(1, 1.0, "i", "s"), (1, 2.0, "i", "s"), (1, 4.0, "j", "s")],
        "encounter_id bigint, amount double, insurance string, payment_status string",
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    mart = factorised.financial_analytics_all(visits, cancers, bills)
    found = [(str(r[0]), r.insurance, r.encounter_count, float(r.total_billing_amount or 0)) for r in mart.collect()]
    day = str(DAY)
    assert sorted(found, key=repr) == sorted(
        [(day, "i", 1, 12.0), (day, "j", 1, 16.0), ("None", "i", 1, 3.0), ("None", "j", 1, 4.0), (day, None, 1, 0.0)], key=repr
    )
    assert not re.search(r"keys=\[[^]]*payment_status#\d+, encounter_id#", physical_plan(mart))
