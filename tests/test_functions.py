import hashlib
from datetime import date

import pytest
from pyspark.sql import functions as F

from layerloom.functions.dates import PRESETS, clamp_window, date_key, preset_start
from layerloom.functions.hashing import record_hash, stable_bucket
from layerloom.functions.parsing import null_if_token, parse_as
from layerloom.functions.text import alias_missing, snake_case, snake_case_columns, strip_name_counter, trim_strings


def test_snake_case():
    assert snake_case("  Patient ID ") == "patient_id"
    assert snake_case("Smoking-Status (self)") == "smoking_status_self"


def test_headers_that_collide_fail(spark):
    with pytest.raises(ValueError, match="collide"):
        snake_case_columns(spark.createDataFrame([(1, 2)], "`A B` int, `A-B` int"))


def test_trim_keeps_tabs_and_other_types(spark):
    df = trim_strings(spark.createDataFrame([("  a\t ", 1)], "s string, n int"))
    assert tuple(df.first()) == ("a\t", 1)


@pytest.mark.parametrize(
    "name, cleaned", [("Ann Lee 12", "Ann Lee"), ("Ann 1 2", "Ann 1"), ("Ann", "Ann"), ("R2", "R2"), (None, None)]
)
def test_strip_name_counter(spark, name, cleaned):
    df = spark.createDataFrame([(name, "keep 7")], "name string, source_file_name string")
    assert tuple(strip_name_counter(df, ["name"]).first()) == (cleaned, "keep 7")


def test_alias_missing(spark):
    df = spark.createDataFrame([(1, 2)], "amount int, name int")
    out = alias_missing(df, {"billing_amount": "amount", "name": "amount", "encounter_date": "date"})
    assert out.columns == ["amount", "name", "billing_amount"]


@pytest.mark.parametrize(
    "text, type_name, value",
    [
        ("3.7", "int", 4),
        (" 12 ", "int", 12),
        ("x", "int", None),
        ("99999999999", "int", None),
        ("2024-01-05", "date", date(2024, 1, 5)),
        ("2024-02-30", "date", None),
        ("01/05/2024", "date", None),
        ("abc", "decimal(18,2)", None),
        (None, "int", None),
    ],
)
def test_parse_gives_null_on_bad_input(spark, text, type_name, value):
    df = spark.createDataFrame([(text,)], "v string")
    assert df.select(parse_as(F.col("v"), type_name)).first()[0] == value


def test_null_tokens(spark):
    df = spark.createDataFrame([("NULL",), ("null",), ("  ",), ("Null",), (None,)], "v string")
    assert [r[0] for r in df.select(null_if_token(F.col("v"))).collect()] == [None, None, None, "Null", None]


def _hash(spark, row, **options):
    df = spark.createDataFrame([row], "a string, b string")
    return df.select(record_hash(["a", "b"], **options)).first()[0]


def test_record_hash_is_the_joined_text(spark):
    assert _hash(spark, ("x", None)) == hashlib.sha256(b"x||").hexdigest()


def test_null_safe_hash_separates_what_the_default_merges(spark):
    for left, right in ((("a", None), ("a", "")), (("a||b", "c"), ("a", "b||c"))):
        assert _hash(spark, left) == _hash(spark, right)
        assert _hash(spark, left, null_safe=True) != _hash(spark, right, null_safe=True)


def test_stable_bucket_matches_plain_python(spark):
    df = spark.range(200).select("id", stable_bucket(F.col("id"), F.lit(7).cast("bigint")).alias("b"))
    for row in df.collect():
        assert row.b == int(hashlib.sha256(str(row.id).encode()).hexdigest()[:15], 16) % 7


def test_stable_bucket_of_nothing_is_null(spark):
    assert spark.range(1).select(stable_bucket(F.col("id"), F.lit(0).cast("bigint"))).first()[0] is None


def test_date_key(spark):
    assert spark.range(1).select(date_key(F.lit(date(2024, 3, 9)))).first()[0] == 20240309


@pytest.mark.parametrize(
    "preset, start",
    [
        ("All Data", date(2022, 1, 1)),
        ("Past Week", date(2024, 3, 24)),
        ("Past Month", date(2024, 2, 29)),
        ("Past 6 Months", date(2023, 9, 30)),
        ("Past 2 Years", date(2022, 3, 31)),
    ],
)
def test_presets(spark, preset, start):
    lower, upper = F.lit(date(2022, 1, 1)), F.lit(date(2024, 3, 31))
    assert spark.range(1).select(preset_start(preset, lower, upper)).first()[0] == start


def test_preset_does_not_reach_before_the_data(spark):
    lower, upper = F.lit(date(2024, 3, 30)), F.lit(date(2024, 3, 31))
    for preset in PRESETS:
        assert spark.range(1).select(preset_start(preset, lower, upper)).first()[0] == date(2024, 3, 30)


def test_unknown_preset():
    with pytest.raises(ValueError, match="unknown preset"):
        preset_start("Yesterday", None, None)


def test_clamp_keeps_start_before_end(spark):
    day = lambda d: F.lit(date(2024, 1, d))
    first, last = clamp_window(day(20), day(5), day(3), day(25))
    assert tuple(spark.range(1).select(first, last).first()) == (date(2024, 1, 20), date(2024, 1, 20))
