"""One registered query per operator, over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.hashing import record_hash
from layerloom.functions.text import alias_missing, strip_name_counter, trim_strings
from layerloom.operators import quality, scd2, star
from layerloom.operators.dedupe import drop_exact_duplicates, first_per_key, latest_per_key
from layerloom.operators.keys import dense_key
from layerloom.operators.masking import (
    PATIENT_POLICIES,
    MaskPolicy,
    apply_masks,
    as_role,
    masked_view,
    pattern_mask,
    reading_as,
    redact,
)
from layerloom.operators.staging import staged_path
from layerloom.plans import factorised, marts, metrics, reports, rollup
from layerloom.sources.bounds import bounding_rows
from layerloom.sources.commits import CommitLog, TableEntry
from layerloom.plans.pipeline import register_views
from layerloom.sources import layers as store
from layerloom.sources.buckets import store_bucketed
from layerloom.sources.delimited import read_by_header, read_by_position, with_lineage, write_csv
from layerloom.sources.specs import BRONZE_REASON, ENCOUNTERS, SILVER_REASON, SourceSpec, bronze_text, typed
from layerloom.sources.versioned import VersionedDimension
from layerloom.suite import roles as r

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def presentable(df: DataFrame) -> DataFrame:
    """Types that read the same from any engine: decimals as double, dates and times as text."""

    def shown(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.substring(c.cast("string"), 1, 19)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.concat_ws("; ", c)
        return c.alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presentable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return build


# --- delimited files ---------------------------------------------------------


CUSTOMER_FILE = SourceSpec(
    name="customer",
    columns=("customer_key", "customer_name", "segment", "balance"),
    keys=("customer_key",),
    required=("customer_key",),
    valid=("customer_key",),
    multiline=True,
)


def _customer_files(spark, d, *orders: tuple[str, ...]) -> str:
    """``customer`` as CSV files, a part of its rows in each order of columns; names hold line breaks."""
    rows = r.table(spark, d, "customer").select(
        F.col("c_custkey").alias("Customer Key"),
        F.regexp_replace("c_name", "#", "\n").alias("Customer-Name"),
        F.col("c_mktsegment").alias("SEGMENT"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
    )
    folder = staged_path(spark, "customer")
    for i, order in enumerate(orders):
        part = rows.where(F.pmod(F.col("Customer Key"), F.lit(len(orders))) == i).select(*[f"`{c}`" for c in order])
        part.write.mode("append").option("header", True).option("escape", '"').csv(folder)
    return folder


_FILE_COLUMNS = ("Customer Key", "Customer-Name", "SEGMENT", "balance")


@query
def csv_by_header(spark, d):
    folder = _customer_files(spark, d, _FILE_COLUMNS, _FILE_COLUMNS[::-1])
    return read_by_header(spark, folder, CUSTOMER_FILE).drop("source_file_name")


@query
def csv_by_position(spark, d):
    return read_by_position(spark, _customer_files(spark, d, _FILE_COLUMNS), CUSTOMER_FILE).drop("source_file_name")


@query
def lineage_columns(spark, d):
    """Run id and load time of every landed row, and that its file is known."""
    landed = read_by_header(spark, _customer_files(spark, d, _FILE_COLUMNS), CUSTOMER_FILE)
    rows = with_lineage(landed, "20210101000000", datetime(2021, 1, 1))
    named = F.col("source_file_name").endswith(".csv").alias("from_csv")
    return rows.select("customer_key", "pipeline_run_id", "ingested_at", named)


@query
def csv_export(spark, d):
    """The patients as an analyst may export them, read back from the written files."""
    folder = staged_path(spark, "export")
    write_csv(as_role("dim_patients", r.patients(spark, d)), folder)
    return spark.read.option("header", True).option("escape", '"').csv(folder)


# --- layer store ---


@query
def latest_load(spark, d):
    """A required table after loads ``run-9`` and ``run-10``: the latter, by number."""
    path = store.Layers(staged_path(spark, "lake")).table("silver", "encounters")
    visits = r.encounters(spark, d)
    store.write_version(visits.where("outcome = 'F'"), path, "run-9")
    store.write_version(visits, path, "run-10")
    return store.read_current(spark, path)


@query
def scan_if_loaded(spark, d):
    """A table that was loaded, and one that never was."""
    lake = store.Layers(staged_path(spark, "lake"))
    visits = r.encounters(spark, d)
    store.write_version(visits, lake.table("gold", "encounters"), "1")
    found = [store.read_current_or_empty(spark, lake.table("gold", t), visits.schema) for t in ("encounters", "visits")]
    one, none = (df.select(F.lit(name).alias("table_name"), "encounter_id") for name, df in zip(("there", "absent"), found))
    return one.unionByName(none)


def _audit_log(spark, d) -> DataFrame:
    """Two runs' row counts of three tables; the second run's first step was repeated."""
    lake = store.Layers(staged_path(spark, "lake"))
    path = lake.table("ops", "pipeline_audit")
    for run_id, ts in (("9", datetime(2020, 1, 1)), ("10", datetime(2021, 1, 1)), ("10", datetime(2021, 1, 1))):
        counts = {t: r.table(spark, d, t).count() for t in ("customer", "orders", "lineitem")}
        rows = [
            {"pipeline_run_id": run_id, "pipeline_step": "raw_to_bronze", "table_name": t, "row_count": n,
             "status": "SUCCESS", "recorded_at": ts} for t, n in counts.items()
        ]
        audit = quality.audit_rows(spark, rows).coalesce(1)
        store.write_log(audit, path, pipeline_run_id=run_id, pipeline_step="raw_to_bronze")
    return store.read_log(spark, path, quality.AUDIT_SCHEMA)


@query
def audit_newest_first(spark, d):
    return quality.newest_audit_first(_audit_log(spark, d))


@query
def latest_run(spark, d):
    """The newest run id among the rows of the fact's source, and how many rows carry one."""
    run_id = F.date_format("o_orderdate", "yyyyMMdd")
    rows = r.table(spark, d, "orders").select(F.when(F.col("o_orderstatus") != "P", run_id).alias("pipeline_run_id"))
    return quality.latest_run(rows)


@query
def named_views(spark, d):
    """SQL over registered names, the current rows of a versioned dimension among them."""
    register_views(
        {
            "dim_patients": _merged(spark, d),
            "dim_cancer_catalog": r.dim_catalog(spark, d),
            "dim_providers": r.provider_dimension(spark, d),
        },
        role="admin",
    )
    return spark.sql(
        "SELECT 'patients' AS of_view, gender AS name, count(*) AS n FROM dim_patients_current GROUP BY gender "
        "UNION ALL SELECT 'catalog', stage, count(*) FROM dim_cancer_catalog_current GROUP BY stage "
        "UNION ALL SELECT 'providers', specialty, count(*) FROM dim_providers GROUP BY specialty"
    )


@query
def audit_observed(spark, d):
    """Counts of a split, taken while it is written."""
    path = store.Layers(staged_path(spark, "lake")).table("bronze", "encounters")
    flagged = _bronze_flagged(spark, d)
    _, counts = store.write_observed(flagged, path, "1", ("rejected",), rejects=F.count_if("rejected"))
    rows = [("raw_to_bronze", "encounters", counts["rows"], counts["rows"] - counts["rejects"], counts["rejects"])]
    return spark.createDataFrame(
        rows, "pipeline_step string, table_name string, source_count bigint, valid_count bigint, reject_count bigint"
    )


@query
def profile_merged(spark, d):
    """Profiles of four loads of the documents, stored and merged; estimates are held against the exact counts."""
    docs = r.table(spark, d, "documents")
    folder = staged_path(spark, "profiles")
    for load in range(4):
        part = docs.where(F.pmod("doc_id", F.lit(4)) == load)
        quality.profile_sketches(part, str(load)).write.mode("append").parquet(folder)
    merged = quality.merged_profile(spark.read.parquet(folder))
    exact = quality.profile(docs).select("column_name", "distinct_count")
    close = F.abs(F.col("approx_distinct") - F.col("distinct_count")) <= 0.05 * F.col("distinct_count")
    return merged.join(exact, "column_name").select(
        "column_name", "row_count", "null_count", "min_number", "max_number", "min_text", close.alias("within_5_percent")
    )


@query
def preview_rows(spark, d):
    """The first 25 encounters by date."""
    return quality.preview(r.encounters(spark, d), ["encounter_date", "encounter_id"], 25)


@query
def column_fallback(spark, d):
    """Columns that a table lacks, from others it has; those it has stay."""
    rows = r.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return alias_missing(rows, {"patient_name": "c_name", "c_mktsegment": "c_name", "lost": "absent"})


# --- cleaning and validation -------------------------------------------------


@query
def trim_strings_(spark, d):
    padded = r.table(spark, d, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
        F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"),
    )
    return trim_strings(padded)


@query
def clean_names(spark, d):
    counted = r.table(spark, d, "customer").select(
        "c_custkey",
        F.concat("c_name", F.when(F.col("c_custkey") % 2 == 0, F.lit(" 12")).otherwise(F.lit(" 1 2"))).alias("c_name"),
    )
    return strip_name_counter(counted, ["c_name"])


def _bronze(spark, d):
    return bronze_text(r.raw_encounters(spark, d), ENCOUNTERS)


@query
def typed_silver(spark, d):
    return typed(_bronze(spark, d), ENCOUNTERS)


def _bronze_flagged(spark, d):
    return quality.flag_rejects(_bronze(spark, d), ENCOUNTERS.bronze_rules)


@query
def bronze_rejects(spark, d):
    return quality.rejected_rows(_bronze_flagged(spark, d), BRONZE_REASON)


@query
def silver_rejects(spark, d):
    flagged = quality.flag_rejects(typed(_bronze(spark, d), ENCOUNTERS), ENCOUNTERS.silver_rules)
    return quality.rejected_rows(flagged, SILVER_REASON)


@query
def valid_reject_split(spark, d):
    """Both halves of the split, side by side."""
    flagged = _bronze_flagged(spark, d)
    valid = quality.valid_rows(flagged).select("encounter_id", F.lit("valid").alias("outcome_of_split"))
    rejected = quality.rejected_rows(flagged, BRONZE_REASON).select(
        "encounter_id", F.lit("rejected").alias("outcome_of_split")
    )
    return valid.unionByName(rejected)


@query
def audit_counts(spark, d):
    """Source, duplicate, valid and reject counts of a step whose input repeats some rows."""
    raw = _bronze(spark, d)
    repeated = raw.unionByName(raw.where(F.col("outcome") == "P"))
    flagged = quality.flag_rejects(drop_exact_duplicates(repeated), ENCOUNTERS.bronze_rules)
    counts = quality.split_counts(flagged).withColumnRenamed("source_count", "distinct_count")
    total = repeated.agg(F.count(F.lit(1))).scalar()
    return counts.select(
        F.lit("raw_to_bronze").alias("pipeline_step"),
        F.lit("encounters").alias("table_name"),
        total.alias("source_count"),
        "valid_count",
        "reject_count",
        (total - F.col("distinct_count")).alias("duplicate_count"),
    )


@query
def reject_payload_json(spark, d):
    return quality.reject_records(
        _bronze_flagged(spark, d),
        run_id="20210101000000",
        step="raw_to_bronze",
        table="encounters",
        reason=BRONZE_REASON,
        rejected_at=scd2.batch_time(datetime(2021, 1, 1)),
    )


@query
def profile_columns(spark, d):
    labelled = r.table(spark, d, "documents").join(r.table(spark, d, "labels"), "doc_id", "left")
    return quality.profile(labelled.select("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"))


# --- keys and dedupe -----------------------------------------------------------


@query
def dedupe_exact(spark, d):
    lines = r.table(spark, d, "lineitem")
    return drop_exact_duplicates(lines.unionByName(lines.where(F.col("l_returnflag") == "R")))


@query
def dedupe_by_key(spark, d):
    return first_per_key(r.table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber"])


@query
def latest_per_key_(spark, d):
    return latest_per_key(r.table(spark, d, "events"), ["user_id", "event_type"], ["ts"])


@query
def first_catalog_per_patient(spark, d):
    rows = r.catalog(spark, d).select("patient_id", "cancer_type", "stage")
    return first_per_key(rows, ["patient_id"], ["cancer_type"])


@query
def record_hash_(spark, d):
    return r.patients(spark, d).select("patient_id", record_hash(r.PATIENT_TRACKED).alias("record_hash"))


@query
def record_hash_null_safe(spark, d):
    rows = r.table(spark, d, "documents").join(r.table(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", record_hash(["lang", "quality", "toxic"], null_safe=True).alias("record_hash"))


@query
def surrogate_keys(spark, d):
    rows = r.table(spark, d, "customer").select("c_mktsegment", "c_custkey")
    return dense_key(rows, ["c_mktsegment", "c_custkey"], "customer_sk")


@query
def surrogate_keys_lines(spark, d):
    rows = r.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return dense_key(rows, ["l_orderkey", "l_linenumber"], "line_sk")


# --- dimensions ------------------------------------------------------------------


@query
def dim_patients_stage(spark, d):
    staged = latest_per_key(r.patients(spark, d), ["patient_id"], [])
    return staged.withColumn("record_hash", record_hash(r.PATIENT_TRACKED))


@query
def dim_patients_seed(spark, d):
    return r.dim_patients(spark, d)


@query
def dim_cancer_catalog(spark, d):
    return r.dim_catalog(spark, d)


@query
def dim_providers(spark, d):
    return r.provider_dimension(spark, d)


@query
def dim_date(spark, d):
    return star.dim_date(r.encounters(spark, d))


SCD2 = (["patient_id"], r.PATIENT_TRACKED, "patient_sk", r.T1)


def _merged(spark, d):
    return scd2.scd2_merge(r.dim_patients(spark, d), r.patients_next(spark, d), *SCD2)


def _compared(spark, d):
    return scd2.compare_snapshot(r.dim_patients(spark, d), r.patients_next(spark, d), *SCD2)


@query
def scd2_merge(spark, d):
    return _merged(spark, d)


@query
def scd2_close_missing(spark, d):
    return scd2.scd2_merge(r.dim_patients(spark, d), r.patients_next(spark, d), *SCD2, close_missing=True)


@query
def dim_current(spark, d):
    return scd2.current_versions(_merged(spark, d))


@query
def scd2_expired(spark, d):
    return _compared(spark, d).where("change = 'expired'").drop("change")


@query
def scd2_carry_forward(spark, d):
    return _compared(spark, d).where("change = 'carried'").drop("change")


@query
def scd2_unchanged(spark, d):
    return _compared(spark, d).where("change = 'unchanged'").drop("change")


@query
def scd2_new_versions(spark, d):
    merged = _merged(spark, d)
    return merged.where(F.col("valid_from") == scd2.batch_time(r.T1))


def _stored_dimension(spark, d) -> tuple[VersionedDimension, dict]:
    """Two loads of the patients in a store of their own, in ranges of some thousand keys."""
    keys, tracked, sk, ts = SCD2
    dimension = VersionedDimension(spark, staged_path(spark, "dim-patients"), keys, tracked, sk, rows_per_range=4000)
    first = dimension.apply(None, r.patients(spark, d), "1", r.T0)
    return dimension, dimension.apply(first, r.patients_next(spark, d), "2", ts)


@query
def scd2_delta_apply(spark, d):
    """The whole dimension after a batch that wrote only the ranges it changed."""
    dimension, state = _stored_dimension(spark, d)
    return dimension.read(state)


@query
def scd2_delta_closed(spark, d):
    """The one folder of history that the batch added."""
    dimension, state = _stored_dimension(spark, d)
    return dimension.closed(state)


@query
def scd2_history_merged(spark, d):
    """History of two loads, which the second has made one folder: what the first reset comes back as it was."""
    keys, tracked, sk, ts = SCD2
    path = staged_path(spark, "dim-history")
    dimension = VersionedDimension(spark, path, keys, tracked, sk, rows_per_range=4000, fan_in=2)
    state = None
    for load, (snapshot, at) in enumerate([(r.patients, r.T0), (r.patients_next, ts), (r.patients, r.T2)]):
        state = dimension.apply(state, snapshot(spark, d), str(load), at)
    return dimension.closed(state)


@query
def manifest_read(spark, d):
    """Two committed sets of tables, and a third load that no reader sees yet."""
    root = staged_path(spark, "table-set")
    log = CommitLog(spark, root)
    visits = r.encounters(spark, d)
    loads = {
        "run-9": {"patients": r.patients(spark, d), "encounters": visits.where("outcome = 'F'")},
        "run-10": {"patients": r.patients_next(spark, d), "encounters": visits},
        "run-11": {"patients": r.patients(spark, d).where("bmi < 0")},
    }
    for n, (run_id, tables) in enumerate(loads.items()):
        written = {name: store.write_version(df, f"{root}/{name}", run_id) for name, df in tables.items()}
        if run_id != "run-11":
            entries = {name: TableEntry.of(df, f"{root}/{name}/version={run_id}") for name, df in written.items()}
            log.put(run_id, entries, after=n)
    shown = None
    for found in (log.read(1), log.read()):
        for name, df in found.read(spark).items():
            key = F.col("patient_id" if name == "patients" else "encounter_id").alias("id")
            rows = df.select(
                F.lit(found.sequence).alias("sequence"),
                F.lit(found.run_id).alias("run_id"),
                F.lit(name).alias("table_name"),
                key,
            )
            shown = rows if shown is None else shown.unionByName(rows)
    return shown


# --- fact and bridge ---------------------------------------------------------------


@query
def provider_assignment(spark, d):
    doctors = r.provider_dimension(spark, d)
    ids = r.encounters(spark, d).select("encounter_id")
    return star.assign_providers(ids, doctors)


@query
def provider_round_robin(spark, d):
    doctors = r.provider_dimension(spark, d)
    return star.rotate_providers(r.encounters(spark, d).select("encounter_id"), doctors)


@query
def fact_date_key(spark, d):
    rows = r.encounters(spark, d).select("encounter_id", "encounter_date")
    return star.with_date_key(rows, star.dim_date(rows))


@query
def fact_encounters_one(spark, d):
    return r.fact(spark, d, "one")


@query
def fact_encounters_all(spark, d):
    return r.fact(spark, d, "all")


@query
def fact_encounters_all_split(spark, d):
    """As above, with every key of more than three rows split."""
    return r.fact(spark, d, "all", rows_per_task=3, sample_rate=1.0, broadcast=False)


@query
def fact_encounters_one_split(spark, d):
    return r.fact(spark, d, rows_per_task=3, sample_rate=1.0, broadcast=False)


def _bucketed(spark, df, key: str) -> DataFrame:
    return store_bucketed(df, staged_path(spark, f"by-{key}"), [key], 16)


@query
def fact_from_buckets(spark, d):
    """Patient and cancer keys of every encounter, looked up bucket by bucket."""
    visits = _bucketed(spark, r.encounters(spark, d).select("encounter_id", "patient_id"), "patient_id")
    people = _bucketed(spark, r.dim_patients(spark, d).select("patient_id", "patient_sk"), "patient_id")
    cancers = first_per_key(r.dim_catalog(spark, d).select("patient_id", "cancer_type", "cancer_sk"), ["patient_id"], ["cancer_type"])
    cancers = _bucketed(spark, cancers.drop("cancer_type"), "patient_id")
    rows = visits.hint("merge").join(people, "patient_id", "left").hint("merge").join(cancers.hint("merge"), "patient_id", "left")
    return rows.select("encounter_id", "patient_sk", "cancer_sk")


@query
def bridge_encounter_provider(spark, d):
    return star.bridge_encounter_provider(r.fact(spark, d))


# --- marts -----------------------------------------------------------------------------


@query
def encounter_overview(spark, d):
    return r.overview(spark, d)


@query
def encounter_overview_all(spark, d):
    return r.overview(spark, d, "all")


@query
def financial_analytics(spark, d):
    return marts.financial_analytics(r.fact(spark, d))


@query
def financial_analytics_all(spark, d):
    return factorised.financial_analytics_all(r.encounters(spark, d), r.catalog(spark, d), r.billing(spark, d))


@query
def provider_performance(spark, d):
    return r.performance(spark, d)


@query
def provider_performance_all(spark, d):
    return factorised.provider_performance_all(
        r.encounters(spark, d), r.catalog(spark, d), r.billing(spark, d), r.provider_dimension(spark, d)
    )


def _rollup(spark, d) -> rollup.Rollup:
    return rollup.build_rollup(r.overview(spark, d))


@query
def metric_provider_rollup_exact(spark, d):
    """Provider measures from stored bitmaps, without the encounter rows."""
    totals = rollup.roll_up(_rollup(spark, d), ["provider_specialty"])
    return totals.select(
        F.col("provider_specialty").alias("specialty"),
        "encounter_count",
        "patient_count",
        "avg_treatment_response_score",
        "total_billing_amount",
    )


@query
def kpi_from_rollup(spark, d):
    return rollup.kpi_from_rollup(_rollup(spark, d))


@query
def monthly_from_rollup(spark, d):
    months = rollup.roll_up(_rollup(spark, d), ["encounter_month"], F.col("encounter_month").isNotNull())
    return months.select(F.col("encounter_month").alias("month"), "encounter_count")


@query
def stage_patients_from_rollup(spark, d):
    """Patients per stage over the months of 1996 and 1997, a range no stored distinct count could be added up to."""
    window = F.col("encounter_month").between("1996-01", "1997-12") & F.col("stage").isNotNull()
    return rollup.roll_up(_rollup(spark, d), ["stage"], window).select("stage", "patient_count")


def _from_files(spark, d):
    owners = r.table(spark, d, "orders").select(F.col("o_orderkey").alias("encounter_id"), "o_custkey")
    line = F.col("billing_id") % 10
    bills = (
        r.billing(spark, d)
        .join(owners, "encounter_id")
        .withColumn("patient_id", F.when(line % 3 == 0, F.lit(-1)).otherwise(F.col("o_custkey")))
        .drop("o_custkey")
    )
    return marts.overview_from_files(
        r.patients(spark, d), r.encounters(spark, d), bills, r.catalog(spark, d), r.provider_dimension(spark, d)
    )


@query
def overview_two_key_join(spark, d):
    """The overview without star tables; every third line's bill names another patient."""
    return _from_files(spark, d)


@query
def financial_from_files(spark, d):
    return marts.financial_from_files(_from_files(spark, d))


@query
def provider_from_files(spark, d):
    return marts.provider_from_files(_from_files(spark, d))


# --- metrics -----------------------------------------------------------------------------


@query
def monthly_encounters(spark, d):
    return metrics.stored_query("monthly_encounters", encounter_overview=r.overview(spark, d))


@query
def stage_revenue(spark, d):
    return metrics.stored_query("stage_revenue", encounter_overview=r.overview(spark, d))


@query
def provider_ranking(spark, d):
    return metrics.stored_query("provider_ranking", provider_performance=r.performance(spark, d))


@query
def metric_by_stage(spark, d):
    return metrics.ENCOUNTER_METRICS.query(
        r.overview(spark, d),
        ["cancer_stage", "treatment"],
        ["encounter_count", "total_billing_amount", "avg_billing_amount"],
    )


@query
def metric_provider_rollup(spark, d):
    return metrics.PROVIDER_METRICS.query(
        r.performance(spark, d),
        ["specialty"],
        ["encounter_count", "patient_count", "avg_treatment_response_score", "total_billing_amount"],
    )


@query
def metric_provider_exact(spark, d):
    return metrics.PROVIDER_METRICS_EXACT.query(
        r.overview(spark, d),
        ["specialty"],
        ["encounter_count", "patient_count", "avg_treatment_response_score", "total_billing_amount"],
    )


@query
def metric_provider_exact_filtered(spark, d):
    return metrics.PROVIDER_METRICS_EXACT.query(
        r.overview(spark, d),
        ["specialty"],
        ["encounter_count", "patient_count", "avg_treatment_response_score", "total_billing_amount"],
        where="outcome <> 'P'",
    )


# --- reports -----------------------------------------------------------------------------


@query
def filtered_overview(spark, d):
    return r.filtered(spark, d)


@query
def date_preset_window(spark, d):
    """The window of every preset, and of a requested range wider than the data."""
    dates = r.encounters(spark, d)
    asked = reports.date_window(dates, start=date(1900, 1, 1), end=date(1997, 6, 30))
    return reports.preset_windows(dates).unionByName(asked.withColumn("preset", F.lit("Requested")))


@query
def date_preset_from_footers(spark, d):
    """The same windows from the bounds in a stored table's footers; no row is read for them."""
    path = staged_path(spark, "encounter-dates")
    r.encounters(spark, d).write.parquet(path)
    dates = bounding_rows(spark, path, "encounter_date")
    asked = reports.date_window(dates, start=date(1900, 1, 1), end=date(1997, 6, 30))
    return reports.preset_windows(dates).unionByName(asked.withColumn("preset", F.lit("Requested")))


@query
def filter_values(spark, d):
    return reports.filter_values(r.overview(spark, d))


@query
def kpi_summary(spark, d):
    return reports.kpi_summary(r.filtered(spark, d))


@query
def kpi_summary_unfiltered(spark, d):
    return reports.kpi_summary(r.overview(spark, d))


@query
def monthly_trend(spark, d):
    return reports.monthly_trend(r.overview(spark, d))


@query
def monthly_trend_filtered(spark, d):
    return reports.monthly_trend(r.filtered(spark, d))


@query
def treatment_mix(spark, d):
    return reports.treatment_mix(r.overview(spark, d))


@query
def treatment_mix_filtered(spark, d):
    return reports.treatment_mix(r.filtered(spark, d))


@query
def stage_distribution(spark, d):
    return reports.stage_distribution(r.overview(spark, d))


@query
def stage_distribution_filtered(spark, d):
    return reports.stage_distribution(r.filtered(spark, d))


@query
def response_by_treatment(spark, d):
    return reports.response_by_treatment(r.overview(spark, d))


@query
def response_by_treatment_filtered(spark, d):
    return reports.response_by_treatment(r.filtered(spark, d))


@query
def revenue_by_payer(spark, d):
    return reports.revenue_by_payer(r.overview(spark, d))


@query
def revenue_by_payer_filtered(spark, d):
    return reports.revenue_by_payer(r.filtered(spark, d))


@query
def payment_status_mix(spark, d):
    return reports.payment_status_mix(r.overview(spark, d))


@query
def payment_status_mix_filtered(spark, d):
    return reports.payment_status_mix(r.filtered(spark, d))


@query
def top_providers_by_encounters(spark, d):
    return reports.top_providers(r.performance(spark, d), "encounter_count")


@query
def top_providers_by_response(spark, d):
    return reports.top_providers(r.performance(spark, d), "avg_treatment_response_score")


@query
def report_bundle(spark, d):
    return reports.report_bundle(r.overview(spark, d))


@query
def report_bundle_filtered(spark, d):
    return reports.report_bundle(r.filtered(spark, d))


# --- governance ----------------------------------------------------------------------------


@query
def mask_patients(spark, d):
    named = r.patients(spark, d).withColumn("row_key", F.col("patient_id"))
    return apply_masks(named, PATIENT_POLICIES, role="analyst")


def _masked_view(spark, d, role: str) -> DataFrame:
    people = r.patients(spark, d)
    people.createOrReplaceTempView("stored_patients")
    masked_view(spark, "patients_for_all", "stored_patients", people.columns, PATIENT_POLICIES)
    with reading_as(spark, role):
        return spark.table("patients_for_all")


@query
def masked_view_analyst(spark, d):
    return _masked_view(spark, d, "analyst")


@query
def masked_view_admin(spark, d):
    return _masked_view(spark, d, "admin")


@query
def mask_catalog(spark, d):
    return as_role("dim_cancer_catalog", r.catalog(spark, d).withColumn("row_key", F.col("patient_id")))


@query
def mask_patients_pattern(spark, d):
    named = r.patients(spark, d).withColumn("row_key", F.col("patient_id"))
    policies = (MaskPolicy("patient_id", pattern_mask), MaskPolicy("patient_name", redact))
    return apply_masks(named, policies, role="restricted")


@query
def mask_patients_privileged(spark, d):
    return apply_masks(r.patients(spark, d), PATIENT_POLICIES, role="admin")


@query
def governance_slice(spark, d):
    return reports.governance_slice(r.overview(spark, d))


@query
def governance_slice_filtered(spark, d):
    return reports.governance_slice(r.filtered(spark, d))


@query
def dq_summary(spark, d):
    """The three checks over the unfiltered overview with every billing row, which is never built."""
    return factorised.dq_summary_all(r.encounters(spark, d), r.catalog(spark, d), r.billing(spark, d))


@query
def dq_summary_filtered(spark, d):
    return quality.dq_summary(
        r.filtered(spark, d), amount="billing_amount", day="encounter_date", key="encounter_id"
    )


# Names that would hide an imported function carry a trailing underscore above.
QUERIES = {name.rstrip("_"): build for name, build in QUERIES.items()}
