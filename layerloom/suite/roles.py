"""The test tables in the roles of the five entities.

customer -> patients, orders -> encounters, lineitem -> billing,
supplier -> providers, events -> cancer catalog.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.operators.dedupe import latest_per_key
from layerloom.operators.scd2 import seed_dimension
from layerloom.operators.star import dim_providers, fact_encounters
from layerloom.plans.marts import encounter_overview, encounter_overview_all, provider_performance
from layerloom.plans.reports import ReportFilter, filter_overview

T0 = "2020-01-01 00:00:00"
T1 = "2021-01-01 00:00:00"
T2 = "2022-01-01 00:00:00"
PATIENT_TRACKED = ("patient_name", "gender", "bmi", "smoking_status", "age")
CATALOG_TRACKED = ("icd_code", "stage", "description", "tumor_markers")
NEW_KEY_OFFSET = 1_000_000_000_000
REPORT_FILTER = ReportFilter(
    treatments=("1-URGENT", "2-HIGH"), payment_statuses=("F",), preset="Past 6 Months"
)


# Stated schemas save a footer-reading job per table.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def patients(spark, d) -> DataFrame:
    nation = table(spark, d, "nation")
    return (
        table(spark, d, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("patient_id"),
            F.col("c_name").alias("patient_name"),
            F.col("c_mktsegment").alias("gender"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("bmi"),
            F.col("n_name").alias("smoking_status"),
            F.col("c_nationkey").alias("age"),
        )
    )


def patients_next(spark, d) -> DataFrame:
    """A later snapshot: negative balances reset, some customers gone, some cloned as new."""
    before = patients(spark, d)
    gone = (F.col("gender") == "HOUSEHOLD") & (F.col("bmi") > 5000)
    kept = before.where(~gone).withColumn(
        "bmi", F.when(F.col("bmi") < 0, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("bmi"))
    )
    new = before.where(F.col("gender") == "MACHINERY").withColumn(
        "patient_id", F.col("patient_id") + F.lit(NEW_KEY_OFFSET)
    )
    return kept.unionByName(new)


def encounters(spark, d) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").select(
        F.col("o_orderkey").alias("encounter_id"),
        F.col("o_custkey").alias("patient_id"),
        day.alias("encounter_date"),
        F.col("o_orderpriority").alias("treatment"),
        F.col("o_orderstatus").alias("drug_regimen"),
        F.dayofmonth(day).alias("number_of_cycles"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("treatment_response_score"),
        F.col("o_orderstatus").alias("outcome"),
    )


def raw_encounters(spark, d) -> DataFrame:
    """Orders as landing text, with blanks, bad dates and bad numbers put in by formula."""
    key = F.col("o_orderkey")
    return table(spark, d, "orders").select(
        key.cast("string").alias("encounter_id"),
        F.when(key % 17 != 0, F.col("o_custkey").cast("string")).alias("patient_id"),
        F.when(key % 13 == 0, F.lit("2024-02-30"))
        .otherwise(F.col("o_orderdate").cast("date").cast("string"))
        .alias("date"),
        F.when(key % 19 == 0, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), F.col("o_orderpriority")))
        .alias("treatment"),
        F.col("o_orderstatus").alias("drug_regimen"),
        F.when(key % 7 == 0, F.lit("bad"))
        .when(key % 7 == 1, F.lit(""))
        .when(key % 7 == 2, F.lit("3.7"))
        .otherwise((key % 30).cast("string"))
        .alias("number_of_cycles"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("treatment_response_score"),
        F.col("o_orderstatus").alias("outcome"),
    )


def billing(spark, d) -> DataFrame:
    return table(spark, d, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("billing_id"),
        F.col("l_orderkey").alias("encounter_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_returnflag").alias("insurance"),
        F.col("l_linestatus").alias("payment_status"),
    )


def providers(spark, d) -> DataFrame:
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    return (
        table(spark, d, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("s_suppkey").alias("provider_id"),
            F.col("s_name").alias("provider_name"),
            F.col("r_name").alias("specialty"),
            F.col("n_name").alias("location"),
            F.col("s_nationkey").alias("experience_years"),
        )
    )


def catalog_history(spark, d) -> DataFrame:
    value = F.col("value")
    return table(spark, d, "events").select(
        F.col("user_id").alias("patient_id"),
        F.col("event_type").alias("cancer_type"),
        value.cast("decimal(18,2)").cast("string").alias("icd_code"),
        F.when(value < 5, "I").when(value < 15, "II").when(value < 40, "III").otherwise("IV").alias("stage"),
        F.col("props").alias("description"),
        F.col("event_id").alias("tumor_markers"),
        F.col("ts").alias("ingested_at"),
    )


def catalog(spark, d) -> DataFrame:
    """Latest row per patient and cancer type."""
    return latest_per_key(
        catalog_history(spark, d), ["patient_id", "cancer_type"], ["ingested_at"]
    ).drop("ingested_at")


def dim_patients(spark, d) -> DataFrame:
    return seed_dimension(patients(spark, d), ["patient_id"], PATIENT_TRACKED, "patient_sk", T0)


def dim_catalog(spark, d) -> DataFrame:
    return seed_dimension(catalog(spark, d), ["patient_id", "cancer_type"], CATALOG_TRACKED, "cancer_sk", T0)


@dataclass(frozen=True)
class Dimensions:
    patients: DataFrame
    catalog: DataFrame
    providers: DataFrame


def dimensions(spark, d) -> Dimensions:
    return Dimensions(dim_patients(spark, d), dim_catalog(spark, d), provider_dimension(spark, d))


def provider_dimension(spark, d) -> DataFrame:
    return dim_providers(providers(spark, d))


def fact(spark, d, cardinality: str = "one", dims: Dimensions | None = None, **limits) -> DataFrame:
    dims = dims or dimensions(spark, d)
    return fact_encounters(
        encounters(spark, d),
        dims.patients,
        dims.catalog,
        billing(spark, d),
        dims.providers,
        cardinality=cardinality,
        **limits,
    )


def overview(spark, d, cardinality: str = "one") -> DataFrame:
    dims = dimensions(spark, d)
    if cardinality == "all":
        return encounter_overview_all(encounters(spark, d), dims.patients, dims.catalog, billing(spark, d), dims.providers)
    return encounter_overview(
        fact(spark, d, cardinality, dims), dims.patients, dims.catalog, dims.providers
    )


def performance(spark, d, cardinality: str = "one") -> DataFrame:
    dims = dimensions(spark, d)
    return provider_performance(fact(spark, d, cardinality, dims), dims.providers)


def filtered(spark, d) -> DataFrame:
    return filter_overview(overview(spark, d), REPORT_FILTER, dates=encounters(spark, d))
