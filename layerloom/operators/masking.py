"""Role-conditioned column masks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What a masked id ends in, what replaces a name, how much of an id shows.
ID_MASK = "****"
NAME_MASK = "REDACTED"
ID_PREFIX = 3


def prefix_mask(value: Column) -> Column:
    """First three characters plus ``****``; masks short values as well."""
    return F.concat(F.substring(value.cast("string"), 1, ID_PREFIX), F.lit(ID_MASK))


def pattern_mask(value: Column) -> Column:
    """As ``prefix_mask``, but values under three characters stay readable."""
    return F.regexp_replace(value.cast("string"), "(^...).*", f"$1{ID_MASK}")


def redact(value: Column) -> Column:
    """``REDACTED`` for every value, NULL too: who has no name does not show."""
    return F.lit(NAME_MASK)


@dataclass(frozen=True)
class MaskPolicy:
    column: str
    mask: Callable[[Column], Column]


PATIENT_POLICIES = (MaskPolicy("patient_id", prefix_mask), MaskPolicy("patient_name", redact))
CATALOG_POLICIES = (MaskPolicy("patient_id", prefix_mask), MaskPolicy("patient_name", redact))

#: Policies bound to stored tables, and to what is read through them.
TABLE_POLICIES = {
    "dim_patients": PATIENT_POLICIES,
    "dim_patients_current": PATIENT_POLICIES,
    "dim_cancer_catalog": CATALOG_POLICIES,
    "dim_cancer_catalog_current": CATALOG_POLICIES,
    "encounter_overview": PATIENT_POLICIES,
}
#: Who reads without asking for a role sees masked values.
DEFAULT_ROLE = "analyst"


def apply_masks(
    df: DataFrame, policies: Sequence[MaskPolicy], role: str, privileged: Sequence[str] = ("admin",)
) -> DataFrame:
    """Mask the policies' columns unless ``role`` is privileged."""
    if role in privileged:
        return df
    return df.withColumns({p.column: p.mask(F.col(p.column)) for p in policies if p.column in df.columns})


def as_role(table: str, df: DataFrame, role: str = DEFAULT_ROLE) -> DataFrame:
    """``df`` as ``role`` may see the stored table of that name."""
    return apply_masks(df, TABLE_POLICIES.get(table, ()), role)


#: The session variable that says as whom a masked view is read.
ROLE_VARIABLE = "reader_role"
#: The masks as SQL text, for views.
MASK_SQL = {
    prefix_mask: f"concat(substring(CAST({{0}} AS STRING), 1, {ID_PREFIX}), '{ID_MASK}')",
    redact: f"'{NAME_MASK}'",
}


def _declare_role(spark: SparkSession) -> None:
    """Every session starts as ``DEFAULT_ROLE``."""
    try:
        spark.sql(f"SELECT session.{ROLE_VARIABLE}").schema
    except AnalysisException:
        spark.sql(f"DECLARE VARIABLE {ROLE_VARIABLE} STRING DEFAULT '{DEFAULT_ROLE}'")


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@contextmanager
def reading_as(spark: SparkSession, role: str) -> Iterator[None]:
    """Masked views resolved inside show what ``role`` may see; whatever was resolved keeps that."""
    _declare_role(spark)
    before = spark.sql(f"SELECT session.{ROLE_VARIABLE}").first()[0]
    spark.sql(f"SET VAR {ROLE_VARIABLE} = {_literal(role)}")
    try:
        yield
    finally:
        spark.sql(f"SET VAR {ROLE_VARIABLE} = {_literal(before)}")


def masked_view(
    spark: SparkSession,
    name: str,
    relation: str,
    columns: Sequence[str],
    policies: Sequence[MaskPolicy],
    privileged: Sequence[str] = ("admin",),
) -> None:
    """One view over ``relation`` (a table, view or ``parquet.`path```) for all roles: masks are decided when it is read.

    Masked columns are text for every role, so that the view has one schema. Only
    masks with SQL text can be stored in a view.
    """
    _declare_role(spark)
    named = {p.column: MASK_SQL[p.mask] for p in policies}
    roles = ", ".join(f"'{r}'" for r in privileged)
    shown = []
    for c in columns:
        quoted = f"`{c.replace('`', '``')}`"
        if c in named:
            masked = named[c].format(quoted)
            quoted = f"CASE WHEN session.{ROLE_VARIABLE} IN ({roles}) THEN CAST({quoted} AS STRING) ELSE {masked} END AS {quoted}"
        shown.append(quoted)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {', '.join(shown)} FROM {relation}")
