"""Layer folders, with each table load in a folder of its own.

A load never overwrites what it may be reading: it writes
``<table>/version=<id>`` and becomes current once that folder is complete.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ZONES = ("raw", "bronze", "silver", "gold", "ops", "export")


@dataclass(frozen=True)
class Layers:
    """Zone paths under one root, on any file system Spark can reach."""

    root: str

    def zone(self, zone: str) -> str:
        if zone not in ZONES:
            raise ValueError(f"unknown zone {zone!r}; expected one of {ZONES}")
        return f"{self.root.rstrip('/')}/{zone}"

    def table(self, zone: str, table: str) -> str:
        return f"{self.zone(zone)}/{table}"

    def landing(self, file_name: str) -> str:
        return f"{self.zone('raw')}/{file_name}"


def version_order(version: str) -> list[tuple[int, int, str]]:
    """Sorts ids with their numbers as numbers: ``run-9`` before ``run-10``."""
    return [(1, int(part), "") if part.isdigit() else (0, 0, part) for part in re.split(r"(\d+)", version) if part]


def complete_versions(spark: SparkSession, table_path: str) -> list[str]:
    """Version ids whose write finished, oldest first; empty only if there are none."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(table_path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    marker = "_SUCCESS"
    children = [status.getPath() for status in fs.listStatus(folder) if status.isDirectory()]
    names = [
        path.getName().removeprefix("version=")
        for path in children
        if path.getName().startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(path, marker))
    ]
    return sorted(names, key=version_order)


def _versions_before(spark: SparkSession, table_path: str, before: str | None) -> list[str]:
    versions = complete_versions(spark, table_path)
    return [v for v in versions if before is None or version_order(v) < version_order(before)]


def write_version(
    df: DataFrame, table_path: str, version: str, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Write one load and return its scan. Repeating a load replaces that load only."""
    path = f"{table_path}/version={version}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_observed(
    df: DataFrame, table_path: str, version: str, partition_by: Sequence[str] = (), **measures: Column
) -> tuple[DataFrame, dict[str, int]]:
    """``write_version``, and ``rows`` and ``measures`` of what passed by while it was written.

    A task that ran twice passed by twice, so the rows are held against the written
    files' footers; only if they differ are the measures taken from the files.
    """
    counted = [F.count(F.lit(1)).alias("rows"), *[m.alias(name) for name, m in measures.items()]]
    seen = Observation()
    written = write_version(df.observe(seen, *counted), table_path, version, partition_by)
    found = dict(seen.get)
    if found["rows"] != written.count():  # reads footers alone
        found = written.agg(*counted).first().asDict()
    return written, found


def read_current(spark: SparkSession, table_path: str, before: str | None = None) -> DataFrame:
    """The latest complete load, or the latest before a given version."""
    versions = _versions_before(spark, table_path, before)
    if not versions:
        raise FileNotFoundError(f"no complete load under {table_path}")
    return spark.read.parquet(f"{table_path}/version={versions[-1]}")


def read_current_or_empty(
    spark: SparkSession, table_path: str, schema: T.StructType, before: str | None = None
) -> DataFrame:
    """As ``read_current``, but a table that was never loaded is empty."""
    versions = _versions_before(spark, table_path, before)
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table_path}/version={versions[-1]}")


def write_log(df: DataFrame, table_path: str, **place: str) -> None:
    """Add one step's rows to a log table, in the partition ``place`` names.

    Repeating the step replaces its rows, so a retried run logs nothing twice.
    """
    folder = "/".join(f"{name}={value}" for name, value in place.items())
    df.drop(*place).write.mode("overwrite").parquet(f"{table_path}/{folder}")


def read_log(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """A log table with its declared types; a run id of digits stays text."""
    return spark.read.schema(schema).parquet(table_path).select(*schema.fieldNames())
