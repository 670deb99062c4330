"""What each landing file holds and which rows are acceptable."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.parsing import null_if_token, parse_as
from layerloom.functions.text import strip_name_counter, trim_strings
from layerloom.operators.quality import Rule, filled, not_null

BRONZE_REASON = "Missing required field"
SILVER_REASON = "Silver validation failed"


@dataclass(frozen=True)
class SourceSpec:
    """One landing file: its columns in file order, types, rules and keys.

    ``types`` lists the columns that are not text. ``renamed`` maps a landing
    name to its name from silver on.
    """

    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    required: tuple[str, ...]
    valid: tuple[str, ...]
    types: dict[str, str] = field(default_factory=dict)
    renamed: dict[str, str] = field(default_factory=dict)
    name_columns: tuple[str, ...] = ()
    #: Quoted values may hold line breaks, so a file is one task's and a large table lands as many files.
    #: Without, Spark can split a file.
    multiline: bool = True

    @property
    def file_name(self) -> str:
        return f"{self.name}.csv"

    @property
    def text_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def bronze_rules(self) -> list[Rule]:
        return [filled(c) for c in self.required]

    @property
    def silver_rules(self) -> list[Rule]:
        return [not_null(c) for c in self.valid]

    def silver_columns(self) -> list[str]:
        return [self.renamed.get(c, c) for c in self.columns]


# Layouts, keys, required columns and types of the five entities.
PATIENTS = SourceSpec(
    name="patients",
    columns=(
        "patient_id",
        "name",
        "dob",
        "gender",
        "stage",
        "bmi",
        "smoking_status",
        "family_history_cancer",
        "radiation_exposure",
        "previous_cancers",
        "age",
    ),
    keys=("patient_id",),
    required=("patient_id", "name", "dob"),
    valid=("patient_id", "dob", "age"),
    types={"dob": "date", "bmi": "decimal(10,2)", "age": "int"},
    name_columns=("name",),
)

PROVIDERS = SourceSpec(
    name="providers",
    columns=("provider_id", "name", "specialty", "location", "years_of_experience"),
    keys=("provider_id",),
    required=("provider_id", "name", "specialty"),
    valid=("provider_id", "years_of_experience"),
    types={"years_of_experience": "int"},
    name_columns=("name",),
)

ENCOUNTERS = SourceSpec(
    name="encounters",
    columns=(
        "encounter_id",
        "patient_id",
        "date",
        "treatment",
        "drug_regimen",
        "number_of_cycles",
        "treatment_response_score",
        "outcome",
    ),
    keys=("encounter_id",),
    required=("encounter_id", "patient_id", "date", "treatment"),
    valid=("encounter_id", "patient_id", "encounter_date"),
    types={"date": "date", "number_of_cycles": "int", "treatment_response_score": "decimal(10,2)"},
    renamed={"date": "encounter_date"},
)

CANCER_CATALOG = SourceSpec(
    name="cancer_catalog",
    columns=("patient_id", "patient_name", "cancer_type", "icd_code", "stage", "description", "tumor_markers"),
    keys=("patient_id", "cancer_type"),
    required=("patient_id", "cancer_type", "icd_code", "stage"),
    valid=("patient_id", "cancer_type", "icd_code"),
    name_columns=("patient_name",),
)

BILLING = SourceSpec(
    name="billing",
    columns=("billing_id", "encounter_id", "patient_id", "patient_name", "amount", "insurance", "payment_status"),
    keys=("billing_id",),
    required=("billing_id", "encounter_id", "patient_id", "amount"),
    valid=("billing_id", "encounter_id", "amount"),
    types={"amount": "decimal(18,2)"},
    name_columns=("patient_name",),
)

SOURCES = {spec.name: spec for spec in (PATIENTS, PROVIDERS, ENCOUNTERS, CANCER_CATALOG, BILLING)}


def bronze_text(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Landing text with spaces trimmed and null tokens turned to NULL."""
    return trim_strings(df).withColumns({c: null_if_token(F.col(c)) for c in spec.columns})


def typed(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Clean names, parse typed columns (bad values become NULL) and rename."""
    cleaned = strip_name_counter(df, spec.name_columns)
    return cleaned.select(
        *[
            (parse_as(F.col(c), spec.types[c]) if c in spec.types else F.col(c)).alias(spec.renamed.get(c, c))
            for c in df.columns
        ]
    )
