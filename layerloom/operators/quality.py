"""Row rules, the valid/rejected split, reject records, audit rows and checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL predicate; a row where it holds is rejected for ``reason``."""

    reason: str
    fails: str


def filled(column: str) -> Rule:
    """Neither NULL nor blank."""
    return Rule(f"{column} missing", f"{column} IS NULL OR trim(CAST({column} AS STRING)) = ''")


def not_null(column: str) -> Rule:
    return Rule(f"{column} invalid", f"{column} IS NULL")


def flag_rejects(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``reject_reasons`` (every broken rule, empty when valid) and ``rejected``."""
    reasons = F.array_compact(
        F.array(*[F.when(F.expr(rule.fails), F.lit(rule.reason)) for rule in rules]).cast("array<string>")
    )
    return df.withColumn("reject_reasons", reasons).withColumn("rejected", F.size("reject_reasons") > 0)


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(~F.col("rejected")).drop("rejected", "reject_reasons")


def rejected_rows(flagged: DataFrame, reason: str) -> DataFrame:
    """Rejected rows with the step's constant reason; ``reject_reasons`` says which rules broke."""
    return flagged.where("rejected").drop("rejected").withColumn("reject_reason", F.lit(reason))


def reject_records(
    flagged: DataFrame, *, run_id: str, step: str, table: str, reason: str, rejected_at: Column
) -> DataFrame:
    """Rejected rows in the layout of the reject store: the source row becomes JSON."""
    payload = [c for c in flagged.columns if c not in ("rejected", "reject_reasons")]
    return flagged.where("rejected").select(
        F.lit(run_id).alias("pipeline_run_id"),
        F.lit(step).alias("pipeline_step"),
        F.lit(table).alias("table_name"),
        F.lit(reason).alias("reject_reason"),
        "reject_reasons",
        rejected_at.alias("rejected_at"),
        F.to_json(F.struct(*payload)).alias("record_payload"),
    )


def split_counts(flagged: DataFrame) -> DataFrame:
    """One row: source, valid and reject counts in a single pass."""
    return flagged.agg(
        F.count(F.lit(1)).alias("source_count"),
        F.count_if(~F.col("rejected")).alias("valid_count"),
        F.count_if("rejected").alias("reject_count"),
    )


AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_run_id", T.StringType()),
        T.StructField("pipeline_step", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("source_count", T.LongType()),
        T.StructField("valid_count", T.LongType()),
        T.StructField("reject_count", T.LongType()),
        T.StructField("duplicate_count", T.LongType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("recorded_at", T.TimestampNTZType()),
    ]
)


def audit_rows(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """Audit rows of one run; counts that do not apply to a step stay NULL."""
    names = AUDIT_SCHEMA.fieldNames()
    unknown = {key for row in rows for key in row} - set(names)
    if unknown:
        raise ValueError(f"not audit columns: {sorted(unknown)}")
    return spark.createDataFrame([tuple(row.get(name) for name in names) for row in rows], AUDIT_SCHEMA)


def latest_run(df: DataFrame) -> DataFrame:
    """One row: the newest run id and the rows that carry any."""
    return df.agg(F.max("pipeline_run_id").alias("pipeline_run_id"), F.count("pipeline_run_id").alias("row_count"))


def newest_audit_first(audit: DataFrame) -> DataFrame:
    return audit.orderBy(F.desc_nulls_last("recorded_at"), "pipeline_step", "table_name")


def dq_summary(df: DataFrame, *, amount: str, day: str, key: str) -> DataFrame:
    """Three checks as rows: missing amounts, missing dates, repeats of a key beyond its first."""
    return dq_rows(
        df.agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(amount).isNull()).alias("no_amount"),
            F.count_if(F.col(day).isNull()).alias("no_day"),
            F.count_distinct(key).alias("keys"),
            F.coalesce(F.max(F.col(key).isNull().cast("bigint")), F.lit(0)).alias("unkeyed"),
        )
    )


def dq_rows(counted: DataFrame) -> DataFrame:
    """The three checks from one row of counts; all NULL keys together are one distinct key."""
    # The names of the checks.
    return counted.select(
        F.expr(
            "stack(3, 'Missing billing amount', no_amount, 'Missing encounter date', no_day, "
            "'Duplicate encounter ids', n - keys - unkeyed) AS (check_name, rows)"
        )
    )


def profile(df: DataFrame, *, approximate: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, smallest and largest as text.

    Exact distinct counts shuffle each column's distinct values once;
    ``approximate=True`` keeps a sketch per column instead.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    measures = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        value = df[f"`{c.replace('`', '``')}`"]
        measures += [
            F.count_if(value.isNull()).alias(f"nulls_{i}"),
            distinct(value).alias(f"distinct_{i}"),
            F.min(value).cast("string").alias(f"min_{i}"),
            F.max(value).cast("string").alias(f"max_{i}"),
        ]
    shown = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("n").alias("row_count"),
            F.col(f"nulls_{i}").alias("null_count"),
            F.col(f"distinct_{i}").alias("distinct_count"),
            F.col(f"min_{i}").alias("min_value"),
            F.col(f"max_{i}").alias("max_value"),
        )
        for i, c in enumerate(df.columns)
    ]
    return df.agg(*measures).select(F.inline(F.array(*shown)))


#: Bits of a sketch's index; the relative error of its distinct count is about 1.04 / 2 ** (bits / 2), 1.6 % here.
SKETCH_BITS = 12


def profile_sketches(df: DataFrame, load: str) -> DataFrame:
    """A row per column of one load: counts, bounds and a sketch of its distinct values, to be merged with other loads'.

    Numbers are bounded as numbers and all else as text, as bounds of text can't be merged into those of numbers.
    """
    measures, shown = [F.count(F.lit(1)).alias("n")], []
    for i, f in enumerate(df.schema.fields):
        value = df[f"`{f.name.replace('`', '``')}`"]
        numeric = isinstance(f.dataType, T.NumericType)
        text = value.cast("string")
        measures += [
            F.count_if(value.isNull()).alias(f"nulls_{i}"),
            F.hll_sketch_agg(text, F.lit(SKETCH_BITS)).alias(f"sketch_{i}"),
            F.min(value.cast("double") if numeric else text).alias(f"min_{i}"),
            F.max(value.cast("double") if numeric else text).alias(f"max_{i}"),
        ]
        bounds = [F.col(f"{side}_{i}") if numeric == number else F.lit(None) for number in (True, False) for side in ("min", "max")]
        shown.append(
            F.struct(
                F.lit(load).alias("load"),
                F.lit(f.name).alias("column_name"),
                F.col("n").alias("row_count"),
                F.col(f"nulls_{i}").alias("null_count"),
                F.col(f"sketch_{i}").alias("sketch"),
                *[
                    b.cast(kind).alias(name)
                    for b, kind, name in zip(
                        bounds, ("double", "double", "string", "string"), ("min_number", "max_number", "min_text", "max_text")
                    )
                ],
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*shown)))


def merged_profile(sketches: DataFrame) -> DataFrame:
    """One row per column over all loads, from their stored sketches alone."""
    return sketches.groupBy("column_name").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"),
        *[F.min(c).alias(c) for c in ("min_number", "min_text")],
        *[F.max(c).alias(c) for c in ("max_number", "max_text")],
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
