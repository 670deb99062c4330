import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from layerloom.operators import masking, quality
from layerloom.sources import layers
from layerloom.sources.buckets import store_bucketed
from plans import physical_plan, rows


@pytest.fixture
def flagged(spark):
    df = spark.createDataFrame(
        [("1", "a", 5), (None, "b", 6), ("  ", None, 7), ("4", "d", None)], "id string, name string, n int"
    )
    return quality.flag_rejects(df, [quality.filled("id"), quality.filled("name"), quality.not_null("n")])


def test_reasons_name_every_broken_rule(flagged):
    found = {r.n: list(r.reject_reasons) for r in flagged.collect()}
    assert found == {5: [], 6: ["id missing"], 7: ["id missing", "name missing"], None: ["n invalid"]}


def test_split_is_a_partition_of_the_source(flagged):
    valid, rejected = quality.valid_rows(flagged), quality.rejected_rows(flagged, "why")
    assert valid.columns == ["id", "name", "n"]
    assert rows(valid) == [("1", "a", 5)]
    assert {r.reject_reason for r in rejected.collect()} == {"why"}
    assert tuple(quality.split_counts(flagged).first()) == (4, 1, 3)


def test_a_rule_that_is_unknown_does_not_reject(spark):
    df = spark.createDataFrame([(None,)], "n int")
    flagged = quality.flag_rejects(df, [quality.Rule("negative", "n < 0")])
    assert not flagged.first().rejected


def test_no_rules_reject_nothing(spark):
    assert not quality.flag_rejects(spark.range(1), []).first().rejected


def test_reject_record_keeps_the_row_as_json(flagged):
    records = quality.reject_records(
        flagged, run_id="r1", step="s", table="t", reason="why", rejected_at=F.lit(datetime(2024, 1, 1))
    )
    payloads = [json.loads(r.record_payload) for r in records.collect()]
    assert {"name": "b", "n": 6} in payloads and len(payloads) == 3
    assert not any("reject_reasons" in p for p in payloads)


def test_audit_rows_fill_what_is_missing(spark):
    audit = quality.audit_rows(spark, [{"pipeline_run_id": "1", "row_count": 3}])
    assert audit.schema == quality.AUDIT_SCHEMA
    assert audit.first().valid_count is None and audit.first().row_count == 3
    with pytest.raises(ValueError, match="not audit columns"):
        quality.audit_rows(spark, [{"rows": 1}])


def test_newest_audit_first(spark):
    audit = quality.audit_rows(
        spark,
        [{"table_name": t, "recorded_at": ts} for t, ts in (("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 2)), ("c", None))],
    )
    assert [r.table_name for r in quality.newest_audit_first(audit).collect()] == ["b", "a", "c"]


def test_latest_run(spark):
    df = spark.createDataFrame([("20240101",), ("20240301",), (None,)], "pipeline_run_id string")
    assert tuple(quality.latest_run(df).first()) == ("20240301", 2)


@pytest.mark.parametrize("ids, repeats", [([1, 1, 2], 1), ([None, None, 1], 1), ([None, 1], 0), ([], 0)])
def test_dq_summary_counts_repeats_beyond_the_first(spark, ids, repeats):
    df = spark.createDataFrame([(i, None, None) for i in ids], "id int, amount double, day date")
    found = dict(tuple(r) for r in quality.dq_summary(df, amount="amount", day="day", key="id").collect())
    assert found == {
        "Missing billing amount": len(ids),
        "Missing encounter date": len(ids),
        "Duplicate encounter ids": repeats,
    }


def test_profile(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (2, "a")], "n int, s string")
    for approximate in (False, True):
        assert rows(quality.profile(df, approximate=approximate)) == [
            ("n", 3, 0, 2, "1", "2"),
            ("s", 3, 1, 2, "a", "b"),
        ]


def test_preview(spark):
    assert rows(quality.preview(spark.range(10), ["id"], 2), "id") == [(0,), (1,)]


def test_profiles_of_loads_merge(spark):
    df = spark.range(1000).selectExpr(
        "id % 700 AS n", "if(id % 9 = 0, NULL, concat('v', id % 50)) AS `odd``name`"
    )
    parts = [quality.profile_sketches(df.where(f"n % 3 = {i}"), str(i)) for i in range(3)] + [quality.profile_sketches(df.limit(0), "none")]
    sketches = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    found = {r.column_name: r for r in quality.merged_profile(sketches).collect()}
    assert found["n"].row_count == 1000 and (found["n"].min_number, found["n"].max_number) == (0.0, 699.0)
    assert abs(found["n"].approx_distinct - 700) <= 35 and found["n"].min_text is None
    odd = found["odd`name"]
    assert (odd.null_count, odd.approx_distinct, odd.min_text, odd.max_text) == (112, 50, "v0", "v9")
    exact = {r.column_name: r.distinct_count for r in quality.profile(df).collect()}
    assert exact == {"n": 700, "odd`name": 50}


def test_counts_are_taken_while_writing(spark, tmp_path, monkeypatch):
    rows = spark.range(100).withColumn("rejected", F.col("id") % 4 == 0)
    written, counts = layers.write_observed(rows, str(tmp_path / "t"), "1", ("rejected",), rejects=F.count_if("rejected"))
    assert counts == {"rows": 100, "rejects": 25} and written.count() == 100
    # a task that was counted twice is found out by the files
    class Twice:
        get = {"rows": 130, "rejects": 40}

    monkeypatch.setattr(layers, "Observation", lambda: Twice())
    monkeypatch.setattr(type(rows), "observe", lambda self, *a: self)
    assert layers.write_observed(rows, str(tmp_path / "t"), "2", rejects=F.count_if("rejected"))[1] == {"rows": 100, "rejects": 25}


def test_one_masked_view_serves_every_role(spark):
    df = spark.createDataFrame([(12345, "Ann", 1), (7, None, 2)], "patient_id int, patient_name string, n int")
    df.createOrReplaceTempView("masked_rows")
    masking.masked_view(spark, "masked_one", "masked_rows", df.columns, masking.PATIENT_POLICIES)
    hidden = [("123****", "REDACTED", 1), ("7****", "REDACTED", 2)]
    assert rows_of(spark.table("masked_one")) == hidden  # who says nothing sees masks
    with masking.reading_as(spark, "admin"):
        open_ = spark.table("masked_one")
        with masking.reading_as(spark, "it's \\ nobody"):
            assert rows_of(spark.table("masked_one")) == hidden
        assert rows_of(spark.table("masked_one")) == [("12345", "Ann", 1), ("7", None, 2)]
    assert rows_of(spark.table("masked_one")) == hidden
    assert rows_of(open_) == [("12345", "Ann", 1), ("7", None, 2)]  # as resolved


def rows_of(df):
    return [tuple(r) for r in df.orderBy("n").collect()]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    a = store_bucketed(spark.range(500).selectExpr("id % 90 AS k", "id AS v"), str(tmp_path / "a"), ["k"], 8)
    b = store_bucketed(spark.range(90).selectExpr("id AS k", "id * 2 AS w"), str(tmp_path / "b"), ["k"], 8)
    joined = a.hint("merge").join(b, "k", "left")
    plan = physical_plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 500 and joined.where("w = 2 * k").count() == 500
    assert "Exchange" not in physical_plan(a.groupBy("k").count())
