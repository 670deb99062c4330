"""Landing files through every layer, over two batches."""

import csv
import gzip
import json
import re
from dataclasses import replace
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from layerloom.operators import quality
from layerloom.plans.pipeline import Batch, Run, read_gold, register_views, run_pipeline, run_step
from layerloom.plans.reports import ReportFilter, filter_overview
from layerloom.sources import delimited
from layerloom.sources import layers as store
from layerloom.sources.commits import CommitLog
from layerloom.sources.delimited import header_fields, read_by_header, read_by_position
from layerloom.sources.layers import Layers
from layerloom.sources.specs import PATIENTS, PROVIDERS, bronze_text
from plans import physical_plan, rows

HEADERS = {
    "patients": "Patient ID,Name,dob,Gender,stage,bmi,Smoking_Status,family_history_cancer,radiation_exposure,previous_cancers,Age",
    "providers": "Provider ID,Name,Specialty,Location,years_of_experience",
    "encounters": "Encounter ID,Patient ID,Date,Treatment,drug_regimen,number_of_cycles,Treatment_Response_Score,outcome",
    "cancer_catalog": "Patient ID,patient_name,Cancer Type,icd_code,Stage,description,tumor_markers",
    "billing": "billing_id,Encounter ID,Patient ID,patient_name,Amount,Insurance,Payment_Status",
}


def patient(pid, name, dob="1960-01-01", bmi="22.5", age="60"):
    return [pid, name, dob, "F", "II", bmi, "never", "no", "no", "none", age]


FIRST = {
    "patients": [
        patient("P001", "Ann Lee 12"),
        patient("P002", "  Bob 1 2 "),
        patient("", "No Id"),
        patient("P003", "No Dob", dob="NULL"),
        patient("P004", "Bad Dob", dob="2024-02-30"),
        patient("P005", "Bad Age", age="x"),
        patient("P006", "Round Age", age="3.7"),
        patient("P001", "Ann Lee 12"),
        patient("P007", "Two Rows", bmi="20"),
        patient("P007", "Two Rows", bmi="21"),
        patient("AB", 'Comma, "Quoted"'),
    ],
    "providers": [
        ["D3", "Cy", "Surgery", "North", "3"],
        ["D1", "Al", "Oncology", "North", "10"],
        ["D2", "Bo", "Oncology", "South", "7"],
        ["D4", "NoSpec", "NULL", "South", "7"],
        ["D5", "BadYears", "Oncology", "South", "many"],
        ["D1", "Al", "Oncology", "East", "11"],
    ],
    "encounters": [
        ["E1", "P001", "2024-01-05", "Chemo", "R1", "3", "7.25", "Improved"],
        ["E2", "P002", "01/05/2024", "Chemo", "R1", "3", "7.25", "Improved"],
        ["E3", "P002", "2024-01-06", " ", "R1", "3", "7.25", "Improved"],
        ["E4", "P999", "2024-01-07", "Radio", "R2", "x", "", "Stable"],
        ["E5", "P002", "2024-02-07", "Radio", "R2", "1", "6", "Stable"],
        ["E5", "P002", "2024-02-07", "Radio", "R2", "2", "6", "Stable"],
        ["E6", "P007", "2024-03-01", "Radio", "R2", "2", "5.5", "Stable"],
    ],
    "cancer_catalog": [
        ["P001", "Ann Lee 12", "Lung", "C34", "II", "a||b", "m"],
        ["P001", "Ann Lee 12", "Bone", "C41", "I", "", "m"],
        ["P002", "Bob", "Skin", "NULL", "I", "d", "m"],
        ["P007", "Two Rows", "Skin", "C43", "I", "d", "m"],
    ],
    "billing": [
        ["B1", "E1", "P001", "Ann", "100.50", "Payer A", "Paid"],
        ["B2", "E1", "P001", "Ann", "50", "Payer B", "Due"],
        ["B3", "E5", "P002", "Bob", "abc", "Payer A", "Paid"],
        ["B4", "E5", "P002", "Bob", "", "Payer A", "Paid"],
        ["B5", "E6", "P007", "Two", "20.00", "null", "Paid"],
        ["B6", "E99", "P007", "Two", "1", "Payer A", "Paid"],
    ],
}
SECOND = FIRST | {
    "patients": [patient("P001", "Ann Lee 12", bmi="30"), patient("P002", "Bob 1 2"), patient("P010", "New One")],
}
BATCHES = [Batch.at(datetime(2024, 5, 1)), Batch.at(datetime(2024, 6, 1))]


def land(root: Path, content) -> None:
    folder = root / "raw"
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in content.items():
        with open(folder / f"{name}.csv", "w", newline="") as f:
            f.write(HEADERS[name] + "\n")
            csv.writer(f).writerows(lines)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    land(root, FIRST)
    first = run_pipeline(spark, str(root), BATCHES[0])
    land(root, SECOND)
    second = run_pipeline(spark, str(root), BATCHES[1])
    return root, first, second


def audit(spark, root, batch, step):
    log = spark.read.parquet(f"{root}/ops/pipeline_audit")
    log = log.where((F.col("pipeline_run_id") == batch.run_id) & (F.col("pipeline_step") == step))
    return {r.table_name: r for r in log.collect()}


def test_bronze_counts(spark, lake):
    found = audit(spark, lake[0], BATCHES[0], "raw_to_bronze")
    counts = {t: (r.source_count, r.valid_count, r.reject_count) for t, r in found.items()}
    assert counts == {
        "patients": (11, 9, 2),
        "providers": (6, 5, 1),
        "encounters": (7, 6, 1),
        "cancer_catalog": (4, 3, 1),
        "billing": (6, 5, 1),
    }


def test_silver_counts_and_invariant(spark, lake):
    found = audit(spark, lake[0], BATCHES[0], "bronze_to_silver")
    counts = {t: (r.source_count, r.valid_count, r.reject_count, r.duplicate_count) for t, r in found.items()}
    assert counts == {
        "patients": (9, 6, 2, 1),
        "providers": (5, 4, 1, 0),
        "encounters": (6, 5, 1, 0),
        "cancer_catalog": (3, 3, 0, 0),
        "billing": (5, 4, 1, 0),
    }
    for r in found.values():
        assert r.source_count == r.valid_count + r.reject_count + r.duplicate_count


def test_rejects_keep_their_row_and_reasons(spark, lake):
    rejects = spark.read.parquet(f"{lake[0]}/ops/rejected_records").where(
        F.col("pipeline_run_id") == BATCHES[0].run_id
    )
    assert rejects.count() == 6 + 5
    blank = rejects.where("table_name = 'patients' AND reject_reason = 'Missing required field'").collect()
    assert {tuple(r.reject_reasons) for r in blank} == {("patient_id missing",), ("dob missing",)}
    assert {json.loads(r.record_payload)["name"] for r in blank} == {"No Id", "No Dob"}


def test_each_half_of_a_split_reads_its_own_files(spark, lake):
    bronze = Run(spark, Layers(str(lake[0])), BATCHES[1]).load("bronze")["billing"]
    assert re.search(r"PartitionFilters: \[[^\]]*rejected", physical_plan(bronze))
    assert "reject_reasons" not in bronze.columns and bronze.count() == 5


def test_silver_is_typed_and_clean(spark, lake):
    patients = store.read_current(spark, f"{lake[0]}/silver/patients", before=BATCHES[1].run_id)
    found = {r.patient_id: r for r in patients.where("NOT rejected AND patient_id <> 'P007'").collect()}
    assert (found["P001"].name, found["P002"].name, found["P006"].age) == ("Ann Lee", "Bob 1", 4)
    assert found["AB"].name == 'Comma, "Quoted"' and found["P001"].dob == date(1960, 1, 1)
    assert {r.source_file_name for r in found.values()} == {"patients.csv"}


def test_patient_versions_over_two_batches(lake):
    dimension = lake[2]["dim_patients"]
    p1 = dimension.where("patient_id = 'P001'").orderBy("patient_sk").collect()
    assert [(float(r.bmi), r.is_current) for r in p1] == [(22.5, False), (30.0, True)]
    assert p1[0].valid_to == p1[1].valid_from == BATCHES[1].ts
    assert dimension.where("patient_id = 'P007' AND is_current").count() == 1
    assert dimension.where("patient_id = 'P010'").count() == 1
    total = dimension.count()
    assert sorted(r.patient_sk for r in dimension.collect()) == list(range(1, total + 1))


def test_catalog_is_unchanged_by_the_same_rows(lake):
    assert lake[1]["dim_cancer_catalog"].count() == lake[2]["dim_cancer_catalog"].count() == 3


def test_fact_has_one_row_per_encounter(lake):
    fact = {r.encounter_id: r for r in lake[1]["fact_encounters"].collect()}
    assert set(fact) == {"E1", "E4", "E5", "E6"}
    assert (fact["E1"].billing_id, float(fact["E1"].billing_amount), fact["E1"].insurance) == ("B1", 100.5, "Payer A")
    assert (fact["E4"].patient_sk, fact["E4"].number_of_cycles, fact["E4"].treatment_response_score) == (None, None, None)
    assert (fact["E5"].number_of_cycles, fact["E5"].billing_id, fact["E5"].date_sk) == (1, None, 20240207)
    assert fact["E6"].insurance is None
    overview = {r.encounter_id: r for r in lake[1]["encounter_overview"].collect()}
    assert (overview["E1"].cancer_type, overview["E1"].stage) == ("Bone", "I")


def test_provider_dimension_and_bridge(lake):
    providers = [(r.provider_sk, r.provider_id, r.experience_years) for r in lake[1]["dim_providers"].orderBy("provider_sk").collect()]
    assert providers[1:] == [(2, "D2", 7), (3, "D3", 3)] and providers[0][:2] == (1, "D1")
    assert lake[1]["bridge_encounter_provider"].count() == 4


def test_all_cardinality_repeats_encounters(spark, tmp_path):
    land(tmp_path, FIRST)
    gold = run_pipeline(spark, str(tmp_path), BATCHES[0], cardinality="all", read=read_by_position, export_csv=False)
    counts = {r.encounter_id: r["count"] for r in gold["fact_encounters"].groupBy("encounter_id").count().collect()}
    assert counts == {"E1": 4, "E4": 1, "E5": 2, "E6": 1}


def test_export_writes_csv_with_headers(spark, lake):
    folder = Layers(str(lake[0])).table("export", "provider_performance")
    back = spark.read.option("header", True).csv(folder)
    assert back.columns == lake[2]["provider_performance"].columns and back.count() == lake[2]["provider_performance"].count()
    assert len(list((lake[0] / "export").iterdir())) == 9


def test_report_reads_only_the_months_it_shows(spark, lake):
    gold = lake[2]
    wanted = ReportFilter(start=date(2024, 2, 1), end=date(2024, 2, 29))
    rows = filter_overview(gold["encounter_overview"], wanted, dates=gold["dim_date"])
    assert [r.encounter_id for r in rows.collect()] == ["E5"]
    assert re.search(r"PartitionFilters: \[[^\]]*encounter_month", physical_plan(rows))


def test_views_answer_sql(spark, lake):
    register_views(lake[2], role="admin")
    assert spark.sql("SELECT count(*) FROM dim_patients_current WHERE patient_id = 'P001'").first()[0] == 1


def test_views_and_exports_hide_people_from_other_roles(spark, lake):
    root, gold = lake[0], lake[2]
    clear = {r.patient_id for r in gold["dim_patients"].collect()} | {r.patient_name for r in gold["dim_patients"].collect()}
    register_views(gold)
    for name in ("dim_patients", "dim_patients_current", "dim_cancer_catalog", "encounter_overview"):
        exported = root / "export" / name
        tables = [spark.table(name)]
        if exported.exists():
            tables.append(spark.read.option("header", True).csv(str(exported)))
        for table in tables:
            shown = [r for r in table.select("patient_id", "patient_name").collect()]
            assert shown and not {v for r in shown for v in r if v} & clear
            assert {r.patient_name for r in shown} == {"REDACTED"}


def test_audit_log_keeps_the_run_id_as_text(spark, lake):
    log = store.read_log(spark, str(lake[0] / "ops" / "pipeline_audit"), quality.AUDIT_SCHEMA)
    assert log.schema["pipeline_run_id"].dataType.simpleString() == "string"
    assert log.columns == quality.AUDIT_SCHEMA.fieldNames() and log.where("pipeline_run_id IS NULL").count() == 0


def test_each_file_of_a_folder_is_read_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "providers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("Provider ID,Name,Specialty,Location,Years of Experience\nD1,Al,onc,X,3\n")
    (folder / "b.csv").write_text("Name,Provider-ID,Extra,Location,Specialty,Years of Experience\nBo,D2,e,Y,rad,4\n")
    got = {tuple(r)[:5] for r in read_by_header(spark, str(folder), PROVIDERS).collect()}
    assert got == {("D1", "Al", "onc", "X", "3"), ("D2", "Bo", "rad", "Y", "4")}
    (folder / "c.csv").write_text("Name,Location\nCy,Z\n")
    with pytest.raises(ValueError, match="c.csv lacks columns"):
        read_by_header(spark, str(folder), PROVIDERS)


@pytest.mark.parametrize(
    "text, fields",
    [
        ("a,b\n1,2\n", ("a", "b")),
        ("\r\n \n\na,b\r\n1,2", ("a", "b")),
        ('"a\nb","c ""d""\r\n",e\n1', ("a\nb", 'c "d"\r\n', "e")),
        ("a,b", ("a", "b")),
        ('a,"b\n', ("a", "b\n")),  # never closed
        ("a\x85b,c\u2028d\n", ("a\x85b", "c\u2028d")),
        ("", ()),
        ("\n\n", ()),
    ],
)
def test_header_fields(text, fields):
    assert header_fields(text, whole=True) == fields
    # any shorter stretch gives the same or asks for more
    for n in range(len(text)):
        assert header_fields(text[:n], whole=False) in (None, fields)


def test_headers_of_odd_files(spark, tmp_path, monkeypatch):
    folder = tmp_path / "odd files%20.csv"
    folder.mkdir()
    plain = "Provider ID,Name,Specialty,Location,Years of Experience\n"
    (folder / "a.csv").write_bytes(b"\xef\xbb\xbf" + plain.encode() + b"D1,Al,onc,X,3\n")
    (folder / "b.csv.gz").write_bytes(gzip.compress(b"Name,Provider ID,Location,Specialty,Years of Experience\nBo,D2,Y,rad,4\n"))
    (folder / "c c.csv").write_text('"Provider\nID","Na\u00efve, ""x""",Name,Specialty,Location,Years of Experience\nD3,n,Cy,onc,Z,5\n')
    (folder / "d.csv").write_text("")
    (folder / "e.csv").write_text(plain)
    want = {("D1", "Al", "onc", "X", "3"), ("D2", "Bo", "rad", "Y", "4"), ("D3", "Cy", "onc", "Z", "5")}
    for size in (16_384, 3):
        monkeypatch.setattr(delimited, "HEAD_BYTES", size)
        found = read_by_header(spark, str(folder), replace(PROVIDERS, multiline=True))
        assert {tuple(r)[:5] for r in found.collect()} == want


def test_line_breaks_in_quotes_and_malformed_records(spark, tmp_path):
    path = tmp_path / "providers.csv"
    path.write_text(
        'Provider ID,Name,Specialty,Location,Years of Experience\nD1,"Al\nB, ""C""",onc,X,3\n'
        "D2,Bo,rad,Y,4,surplus\nD3,Cy\nD4,Di,onc,Z,5\n"
    )
    spec = replace(PROVIDERS, multiline=True)
    for read in (read_by_header, read_by_position):
        rows = {r.provider_id: r for r in read(spark, str(path), spec).collect()}
        assert set(rows) == {"D1", "D2", "D3", "D4"} and rows["D1"].name == 'Al\nB, "C"'
        assert {k for k, r in rows.items() if r.malformed_record} == {"D2", "D3"}
        assert "surplus" in rows["D2"].malformed_record


def test_malformed_records_are_rejected_with_their_text(spark, tmp_path):
    land(tmp_path, FIRST)
    path = tmp_path / "raw" / "providers.csv"
    path.write_text(path.read_text() + "D9,Zed,onc,X,3,surplus\n")
    run_step(spark, str(tmp_path), "bronze", BATCHES[0])
    found = spark.read.parquet(str(tmp_path / "ops" / "rejected_records")).where("table_name = 'providers'")
    assert any("malformed record" in r.reject_reasons and "surplus" in r.record_payload for r in found.collect())


def test_missing_landing_file_fails(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        run_pipeline(spark, str(tmp_path), BATCHES[0])


def test_header_reader_reorders_and_checks(spark, tmp_path):
    names = HEADERS["patients"].split(",")
    path = tmp_path / "patients.csv"
    path.write_text(",".join(reversed(names)) + "\n" + ",".join(reversed(patient("P1", "A"))) + "\n")
    assert read_by_header(spark, str(path), PATIENTS).first().patient_id == "P1"
    path.write_text("Patient ID,Name\nP1,A\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_by_header(spark, str(path), PATIENTS)


def test_position_reader_ignores_headers(spark, tmp_path):
    path = tmp_path / "patients.csv"
    path.write_text(",".join("abcdefghijk") + "\n" + ",".join(patient("P1", "NULL")) + "\n")
    row = bronze_text(read_by_position(spark, str(path), PATIENTS), PATIENTS).first()
    assert (row.patient_id, row.name, row.source_file_name) == ("P1", None, "patients.csv")


def test_an_unfinished_load_is_never_read(spark, tmp_path):
    table = str(tmp_path / "t")
    schema = spark.range(1).schema
    assert store.read_current_or_empty(spark, table, schema).count() == 0
    with pytest.raises(FileNotFoundError):
        store.read_current(spark, table)
    store.write_version(spark.range(3), table, "1")
    store.write_version(spark.range(5), table, "2")
    (tmp_path / "t" / "version=2" / "_SUCCESS").unlink()
    assert store.read_current(spark, table).count() == 3
    with pytest.raises(ValueError, match="unknown zone"):
        Layers("x").zone("platinum")


def test_a_table_can_be_rewritten_from_itself(spark, tmp_path):
    table = str(tmp_path / "t")
    store.write_version(spark.range(3), table, "1")
    for version in ("2", "3"):
        grown = store.read_current(spark, table).union(spark.range(1))
        store.write_version(grown, table, version)
    assert store.read_current(spark, table).count() == 5


def test_steps_run_one_by_one_like_the_whole(spark, lake, tmp_path):
    land(tmp_path, FIRST)
    with pytest.raises(FileNotFoundError, match="bronze/patients"):
        run_step(spark, str(tmp_path), "silver", BATCHES[0])
    with pytest.raises(ValueError, match="unknown step"):
        run_step(spark, str(tmp_path), "platinum", BATCHES[0])
    for step in ("bronze", "silver"):
        run_step(spark, str(tmp_path), step, BATCHES[0])
    gold = run_step(spark, str(tmp_path), "gold", BATCHES[0])
    for table in ("dim_patients", "fact_encounters"):
        assert rows(gold[table]) == rows(lake[1][table])


# Last: it rewrites the files the tests above read.
def test_a_repeated_run_writes_the_same(spark, lake):
    root, _, second = lake
    before = {name: rows(second[name]) for name in ("dim_patients", "fact_encounters")}
    rejects = spark.read.parquet(f"{root}/ops/rejected_records").count()
    again = run_pipeline(spark, str(root), BATCHES[1], export_csv=False)
    assert {name: rows(again[name]) for name in before} == before
    assert spark.read.parquet(f"{root}/ops/rejected_records").count() == rejects
    log = CommitLog(spark, f"{root}/gold")
    assert [log.read(n).run_id for n in log.sequences()] == [b.run_id for b in (*BATCHES, BATCHES[1])]
    assert store.complete_versions(spark, f"{root}/gold/fact_encounters") == [
        *[b.run_id for b in BATCHES], f"{BATCHES[1].run_id}-2"
    ]
    first, latest = read_gold(spark, str(root), 1), read_gold(spark, str(root))
    assert rows(first["dim_patients"]) == rows(lake[1]["dim_patients"])
    assert {name: rows(latest[name]) for name in before} == before and set(first) == set(latest)
    # the catalogue did not change: all commits name the same folders, and no history was written
    states = [log.read(n).tables["dim_cancer_catalog"].facts["state"] for n in log.sequences()]
    assert states[0] == states[1] == states[2] and not states[0]["closed"]
