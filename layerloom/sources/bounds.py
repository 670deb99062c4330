"""Smallest and largest values of stored columns from Parquet footers, without reading rows.

Each file's footer holds the bounds of its row groups. Spark's own Parquet reader
for its newer source API answers MIN and MAX from them when told to; the settings are
made in a session of their own, so the caller's plans stay as they are. A row group that
holds only NULLs has no bounds and ends such a query; the column is then read as usual. Dates and
numbers have such bounds; for texts and times Spark reads the column instead, with
the same result. Files must come from writers that keep statistics, as Spark's does.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# How Spark's reader reports a row group whose column has no value, so no bounds either.
NO_BOUNDS = "No min/max found for Parquet file"


def _bounds(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))])


def footer_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row with ``min_<column>`` and ``max_<column>``; fails on row groups in which a column is always NULL."""
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return _bounds(reader.read.parquet(path), columns)


def column_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> Row:
    """The same row, evaluated; the columns are read where a footer lacks bounds. NULL where there is no value."""
    try:
        return footer_bounds(spark, path, columns).first()
    except (Py4JJavaError, PySparkException) as error:
        if NO_BOUNDS not in str(error):
            raise
    return _bounds(spark.read.parquet(path), columns).first()


def bounding_rows(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``column`` with its two bounds as rows; they stand for the table in ``min`` and ``max``."""
    kind = spark.read.parquet(path).schema[column].dataType
    values = [(value,) for value in column_bounds(spark, path, [column])]
    return spark.createDataFrame(values, T.StructType([T.StructField(column, kind)]))
