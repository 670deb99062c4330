"""One batch from landing files to marts: raw, bronze, silver, gold, export."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.functions.dates import month_label
from layerloom.operators import quality, star
from layerloom.operators.dedupe import drop_exact_duplicates, latest_per_key
from layerloom.operators.masking import DEFAULT_ROLE, as_role
from layerloom.operators.scd2 import batch_time, current_versions
from layerloom.operators.staging import staging_scope
from layerloom.plans import marts
from layerloom.sources import layers as store
from layerloom.sources.commits import Commit, CommitLog, TableEntry
from layerloom.sources.delimited import MALFORMED, WELL_FORMED, read_by_header, with_lineage, write_csv
from layerloom.sources.layers import Layers
from layerloom.sources.specs import BRONZE_REASON, SILVER_REASON, SOURCES, SourceSpec, bronze_text, typed
from layerloom.sources.versioned import VersionedDimension

LINEAGE = ("pipeline_run_id", "ingested_at", "source_file_name")
#: Commits of the gold tables that stay readable.
KEPT_COMMITS = 30

# Business keys, surrogate keys and tracked columns of the versioned dimensions.
PATIENT_KEYS = ["patient_id"]
PATIENT_SK = "patient_sk"
PATIENT_TRACKED = [
    "patient_name",
    "dob",
    "gender",
    "stage",
    "bmi",
    "smoking_status",
    "family_history_cancer",
    "radiation_exposure",
    "previous_cancers",
    "age",
]
CATALOG_KEYS = ["patient_id", "cancer_type"]
CATALOG_SK = "cancer_sk"
CATALOG_TRACKED = ["patient_name", "icd_code", "stage", "description", "tumor_markers"]


@dataclass(frozen=True)
class Batch:
    """Identity and instant of a run; both are the same for every row it writes."""

    run_id: str
    ts: datetime

    @classmethod
    def at(cls, ts: datetime | None = None) -> Batch:
        instant = ts or datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
        return cls(instant.strftime("%Y%m%d%H%M%S"), instant)


@dataclass
class Run:
    """A pipeline run: where it writes, and the audit rows it has gathered."""

    spark: SparkSession
    layers: Layers
    batch: Batch
    audit: list[dict] = field(default_factory=list)

    def record(self, step: str, table: str, **counts: int) -> None:
        self.audit.append(
            {
                "pipeline_run_id": self.batch.run_id,
                "pipeline_step": step,
                "table_name": table,
                "status": "SUCCESS",
                "recorded_at": self.batch.ts,
                **counts,
            }
        )

    def load(self, zone: str) -> dict[str, DataFrame]:
        """Valid rows of every entity as an earlier step left them; an error if one is absent."""
        stored = {
            name: store.read_current(self.spark, self.layers.table(zone, name)) for name in SOURCES
        }
        return {
            name: quality.valid_rows(df.withColumn("rejected", F.col("rejected").cast("boolean")))
            for name, df in stored.items()
        }

    def flush_audit(self, step: str) -> None:
        rows = [row for row in self.audit if row["pipeline_step"] == step]
        store.write_log(
            quality.audit_rows(self.spark, rows).coalesce(1),
            self.layers.table("ops", "pipeline_audit"),
            pipeline_run_id=self.batch.run_id,
            pipeline_step=step,
        )


def _store_split(run: Run, zone: str, step: str, spec: SourceSpec, flagged: DataFrame, reason: str) -> tuple[DataFrame, int, int]:
    """Write valid and rejected rows in one pass; return the valid scan and both counts.

    The split is a partition of the written table, so reading one half skips
    the other's files. Counts are taken while it is written and held against the
    files, so a retried task cannot inflate them.
    """
    written, counts = store.write_observed(
        flagged,
        run.layers.table(zone, spec.name),
        run.batch.run_id,
        ("rejected",),
        rejects=F.count_if("rejected"),
    )
    records = quality.reject_records(
        written,
        run_id=run.batch.run_id,
        step=step,
        table=spec.name,
        reason=reason,
        rejected_at=batch_time(run.batch.ts),
    )
    store.write_log(
        records,
        run.layers.table("ops", "rejected_records"),
        pipeline_run_id=run.batch.run_id,
        pipeline_step=step,
        table_name=spec.name,
    )
    return quality.valid_rows(written), counts["rows"] - counts["rejects"], counts["rejects"]


def to_bronze(run: Run, read: Callable[[SparkSession, str, SourceSpec], DataFrame] = read_by_header) -> dict[str, DataFrame]:
    """Landing files to trimmed text with lineage; rows without required fields are rejected."""
    bronze = {}
    for spec in SOURCES.values():
        landed = read(run.spark, run.layers.landing(spec.file_name), spec)
        rows = with_lineage(bronze_text(landed, spec), run.batch.run_id, run.batch.ts)
        flagged = quality.flag_rejects(rows, [WELL_FORMED, *spec.bronze_rules])
        valid, kept, rejected = _store_split(run, "bronze", "raw_to_bronze", spec, flagged, BRONZE_REASON)
        run.record(
            "raw_to_bronze", spec.name, source_count=kept + rejected, valid_count=kept, reject_count=rejected, duplicate_count=0
        )
        bronze[spec.name] = valid.drop(MALFORMED)
    run.flush_audit("raw_to_bronze")
    return bronze


def to_silver(run: Run, bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Distinct, typed rows; rows whose key columns do not parse are rejected."""
    silver = {}
    for spec in SOURCES.values():
        rows = bronze[spec.name].drop(MALFORMED)
        flagged = quality.flag_rejects(typed(drop_exact_duplicates(rows, spec.columns), spec), spec.silver_rules)
        valid, kept, rejected = _store_split(run, "silver", "bronze_to_silver", spec, flagged, SILVER_REASON)
        source = rows.count()
        run.record(
            "bronze_to_silver",
            spec.name,
            source_count=source,
            valid_count=kept,
            reject_count=rejected,
            duplicate_count=source - kept - rejected,
        )
        silver[spec.name] = valid
    run.flush_audit("bronze_to_silver")
    return silver


class GoldLoad:
    """The gold tables of one attempt of a run: written to folders of their own, then committed as a set.

    It starts from the last commit before the run's own, so repeating a run starts
    from the same state, and writes over nothing that a commit names.
    """

    def __init__(self, run: Run):
        self.run, self.log = run, CommitLog(run.spark, run.layers.zone("gold"))
        self.latest = max(self.log.sequences(), default=0)
        self.base, own = self.log.before(run.batch.run_id)
        self.load = f"{run.batch.run_id}-{own + 1}" if own else run.batch.run_id
        self.entries: dict[str, TableEntry] = {}
        self.tables: dict[str, DataFrame] = {}

    def write(self, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = self.run.layers.table("gold", table)
        written = store.write_version(df, path, self.load, partition_by)
        self.entries[table] = TableEntry.of(written, f"{path}/version={self.load}")
        self.tables[table] = written
        return written

    def write_by_month(self, table: str, rows: DataFrame) -> DataFrame:
        """Store by encounter month: small months share a task, a large one gets many files."""
        labelled = rows.withColumn("encounter_month", month_label(F.col("encounter_date")))
        return self.write(table, labelled.hint("rebalance", "encounter_month"), ("encounter_month",))

    def merge(self, table: str, incoming: DataFrame, keys, tracked, sk: str) -> DataFrame:
        """Bring a versioned dimension up to date; its current versions."""
        dimension = VersionedDimension(self.run.spark, self.run.layers.table("gold", table), keys, tracked, sk)
        known = self.base.tables.get(table) if self.base else None
        state = dimension.apply(known and known.facts["state"], incoming, self.load, self.run.batch.ts)
        self.tables[table] = dimension.read(state)
        self.entries[table] = TableEntry.of(self.tables[table], *dimension.paths(state), state=state)
        return dimension.current(state)

    def commit(self) -> Commit:
        made = self.log.put(self.run.batch.run_id, self.entries, after=self.latest)
        self.log.expire(KEPT_COMMITS)
        return made


def read_gold(spark: SparkSession, root: str, sequence: int | None = None) -> dict[str, DataFrame]:
    """The gold tables of one commit, by default the latest, whatever is being loaded meanwhile."""
    found = CommitLog(spark, Layers(root).zone("gold")).read(sequence)
    if found is None:
        raise FileNotFoundError(f"nothing is committed under {Layers(root).zone('gold')}")
    return found.read(spark)


def to_gold(run: Run, silver: Mapping[str, DataFrame], cardinality: str = "one") -> dict[str, DataFrame]:
    """Dimensions, fact, bridge and marts. Each table is stored before the next reads it; readers see them all at once."""
    business = {name: df.drop(*LINEAGE, "reject_reasons") for name, df in silver.items()}
    latest = {
        name: latest_per_key(silver[name], SOURCES[name].keys, ["ingested_at"]).drop(*LINEAGE)
        for name in ("patients", "cancer_catalog")
    }
    gold = GoldLoad(run)
    patients = gold.merge(
        "dim_patients",
        latest["patients"].withColumnRenamed("name", "patient_name"),
        PATIENT_KEYS,
        PATIENT_TRACKED,
        PATIENT_SK,
    )
    catalog = gold.merge(
        "dim_cancer_catalog",
        latest["cancer_catalog"],
        CATALOG_KEYS,
        CATALOG_TRACKED,
        CATALOG_SK,
    )
    loaded_at = batch_time(run.batch.ts).alias("loaded_at")
    doctors = silver["providers"].withColumnsRenamed(
        {"name": "provider_name", "years_of_experience": "experience_years"}
    )
    providers = gold.write("dim_providers", star.dim_providers(doctors, ["ingested_at"]).select("*", loaded_at))
    gold.write("dim_date", star.dim_date(business["encounters"]).select("*", loaded_at))

    fact = star.fact_encounters(
        business["encounters"],
        patients,
        catalog,
        business["billing"],
        providers,
        cardinality=cardinality,
    ).select("*", F.lit(run.batch.run_id).alias("pipeline_run_id"), loaded_at)
    stored = gold.write_by_month("fact_encounters", fact).drop("encounter_month")
    gold.write("bridge_encounter_provider", star.bridge_encounter_provider(stored).select("*", loaded_at))
    gold.write_by_month(
        "encounter_overview",
        marts.encounter_overview(
            stored.drop("pipeline_run_id", "loaded_at"), patients, catalog, providers, busy=marts.busy_keys(stored)
        ),
    )
    gold.write("financial_analytics", marts.financial_analytics(stored))
    gold.write("provider_performance", marts.provider_performance(stored, providers))
    for table, df in gold.tables.items():
        run.record("silver_to_gold", table, row_count=df.count())
    run.flush_audit("silver_to_gold")
    gold.commit()
    return gold.tables


def export(run: Run, gold: Mapping[str, DataFrame], role: str = DEFAULT_ROLE) -> dict[str, str]:
    """The published tables as ``role`` sees them, as folders of CSV parts written by the executors."""
    published = {
        "dim_patients_current": current_versions(gold["dim_patients"]),
        "dim_cancer_catalog_current": current_versions(gold["dim_cancer_catalog"]),
        "dim_providers": gold["dim_providers"],
        "dim_date": gold["dim_date"],
        "fact_encounters": gold["fact_encounters"].drop("encounter_month"),
        "encounter_overview": gold["encounter_overview"].drop("encounter_month"),
        "financial_analytics": gold["financial_analytics"],
        "provider_performance": gold["provider_performance"],
        "pipeline_audit": store.read_log(run.spark, run.layers.table("ops", "pipeline_audit"), quality.AUDIT_SCHEMA),
    }
    paths = {}
    for name, df in published.items():
        paths[name] = run.layers.table("export", name)
        write_csv(as_role(name, df, role), paths[name])
    return paths


def register_views(gold: Mapping[str, DataFrame], role: str = DEFAULT_ROLE) -> None:
    """Name the gold tables, and the current rows of the versioned ones, for SQL as ``role`` sees them."""
    for name, df in gold.items():
        as_role(name, df, role).createOrReplaceTempView(name)
    for name in ("dim_patients", "dim_cancer_catalog"):
        as_role(name, current_versions(gold[name]), role).createOrReplaceTempView(f"{name}_current")


def run_pipeline(
    spark: SparkSession,
    root: str,
    batch: Batch | None = None,
    *,
    cardinality: str = "one",
    read: Callable[[SparkSession, str, SourceSpec], DataFrame] = read_by_header,
    export_csv: bool = True,
    role: str = DEFAULT_ROLE,
) -> dict[str, DataFrame]:
    """Run every step in order and return the gold tables."""
    run = Run(spark, Layers(root), batch or Batch.at())
    with staging_scope(spark):
        gold = to_gold(run, to_silver(run, to_bronze(run, read)), cardinality)
        if export_csv:
            export(run, gold, role)
    return gold


STEPS = ("bronze", "silver", "gold", "all")


def run_step(spark: SparkSession, root: str, step: str, batch: Batch | None = None, *, cardinality: str = "one"):
    """Run one step by itself, reading what the step before it stored."""
    if step not in STEPS:
        raise ValueError(f"unknown step {step!r}; expected one of {STEPS}")
    if step == "all":
        return run_pipeline(spark, root, batch, cardinality=cardinality)
    run = Run(spark, Layers(root), batch or Batch.at())
    if step == "bronze":
        return to_bronze(run)
    if step == "silver":
        return to_silver(run, run.load("bronze"))
    with staging_scope(spark):
        return to_gold(run, run.load("silver"), cardinality)


def main() -> None:
    import argparse

    parser = argparse.ArgumentParser(description="Run a batch over the landing files under ROOT/raw.")
    parser.add_argument("root", help="any URI Spark can read and write")
    parser.add_argument("--step", choices=STEPS, default="all")
    parser.add_argument("--cardinality", choices=("one", "all"), default="one")
    parser.add_argument(
        "--run-at", type=datetime.fromisoformat, help="the batch's instant; steps given the same one are one run"
    )
    arguments = parser.parse_args()
    run_step(
        SparkSession.builder.getOrCreate(),
        arguments.root,
        arguments.step,
        Batch.at(arguments.run_at),
        cardinality=arguments.cardinality,
    )


if __name__ == "__main__":
    main()
