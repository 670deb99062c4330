"""Bounds of stored columns come from footers and equal those of the rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from layerloom.plans import reports
from layerloom.sources.bounds import bounding_rows, column_bounds, footer_bounds
from plans import physical_plan

SCHEMA = "encounter_date date, n bigint, name string"


def stored(spark, folder, rows, parts=3):
    path = str(folder / "table")
    spark.createDataFrame(rows, SCHEMA).repartition(parts).write.parquet(path)
    return path


def row_bounds(spark, path, columns):
    pairs = [f(c) for c in columns for f in (F.min, F.max)]
    return tuple(spark.read.parquet(path).agg(*pairs).first())


def test_dates_and_numbers_are_answered_without_rows(spark, tmp_path):
    rows = [(date(2020, 1 + i % 12, 1 + i % 28), i * 7 - 50, f"n{i}") for i in range(500)]
    path = stored(spark, tmp_path, [*rows, (None, None, None)])
    bounds = footer_bounds(spark, path, ["encounter_date", "n"])
    assert "PushedAggregation: [MIN(encounter_date), MAX(encounter_date), MIN(n), MAX(n)]" in physical_plan(bounds)
    assert tuple(bounds.first()) == row_bounds(spark, path, ["encounter_date", "n"])


@pytest.mark.parametrize(
    "rows",
    [[], [(None, None, None)] * 5, [(date(2024, 2, 29), 1, "x")], [(None, 3, None), (date(1999, 1, 1), None, "")]],
    ids=["empty", "only nulls", "one row", "some nulls"],
)
def test_tables_without_values(spark, tmp_path, rows):
    path = stored(spark, tmp_path, rows)
    assert tuple(column_bounds(spark, path, ["encounter_date", "n"])) == row_bounds(spark, path, ["encounter_date", "n"])


def test_texts_are_read_with_the_same_result(spark, tmp_path):
    path = stored(spark, tmp_path, [(None, 1, "b"), (None, 2, "a" * 200), (None, 3, None)])
    assert tuple(column_bounds(spark, path, ["name"])) == ("a" * 200, "b")


def test_windows_from_bounds_equal_those_from_rows(spark, tmp_path):
    path = stored(spark, tmp_path, [(date(2015 + i % 9, 1 + i % 12, 3), i, "") for i in range(200)])
    from_rows = reports.preset_windows(spark.read.parquet(path)).collect()
    assert reports.preset_windows(bounding_rows(spark, path, "encounter_date")).collect() == from_rows


def test_the_callers_session_is_left_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    path = stored(spark, tmp_path, [(date(2020, 1, 1), 1, "x")])
    column_bounds(spark, path, ["n"])
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert "PushedAggregation" not in physical_plan(spark.read.parquet(path).agg(F.max("n")))
