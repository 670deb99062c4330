"""The registered queries as SQL, written against the test tables."""

from __future__ import annotations

from layerloom.suite.roles import NEW_KEY_OFFSET, T0, T1, T2

CTES = {
    "patients": """
        SELECT c_custkey AS patient_id, c_name AS patient_name, c_mktsegment AS gender,
               CAST(c_acctbal AS DECIMAL(18,2)) AS bmi, n_name AS smoking_status, c_nationkey AS age
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "patients_next": f"""
        SELECT patient_id, patient_name, gender,
               CASE WHEN bmi < 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE bmi END AS bmi, smoking_status, age
        FROM patients WHERE NOT (gender = 'HOUSEHOLD' AND bmi > 5000)
        UNION ALL
        SELECT patient_id + {NEW_KEY_OFFSET}, patient_name, gender, bmi, smoking_status, age
        FROM patients WHERE gender = 'MACHINERY'""",
    "encounters": """
        SELECT o_orderkey AS encounter_id, o_custkey AS patient_id, CAST(o_orderdate AS DATE) AS encounter_date,
               o_orderpriority AS treatment, o_orderstatus AS drug_regimen,
               CAST(day(o_orderdate) AS INTEGER) AS number_of_cycles,
               CAST(o_totalprice AS DECIMAL(18,2)) AS treatment_response_score, o_orderstatus AS outcome
        FROM orders""",
    "raw_encounters": """
        SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id,
               CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS patient_id,
               CASE WHEN o_orderkey % 13 = 0 THEN '2024-02-30'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderpriority END AS treatment,
               o_orderstatus AS drug_regimen,
               CASE o_orderkey % 7 WHEN 0 THEN 'bad' WHEN 1 THEN NULL WHEN 2 THEN '3.7'
                    ELSE CAST(o_orderkey % 30 AS VARCHAR) END AS number_of_cycles,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS treatment_response_score,
               o_orderstatus AS outcome
        FROM orders""",
    "bronze_flagged": """
        SELECT *, concat_ws('; ', CASE WHEN encounter_id IS NULL THEN 'encounter_id missing' END,
                            CASE WHEN patient_id IS NULL THEN 'patient_id missing' END,
                            CASE WHEN date IS NULL THEN 'date missing' END,
                            CASE WHEN treatment IS NULL THEN 'treatment missing' END) AS reject_reasons
        FROM raw_encounters""",
    "typed_encounters": """
        SELECT encounter_id, patient_id, TRY_CAST(date AS DATE) AS encounter_date, treatment, drug_regimen,
               CAST(TRY_CAST(number_of_cycles AS DECIMAL(38,0)) AS INTEGER) AS number_of_cycles,
               TRY_CAST(treatment_response_score AS DECIMAL(10,2)) AS treatment_response_score, outcome
        FROM raw_encounters""",
    "billing": """
        SELECT l_orderkey * 10 + l_linenumber AS billing_id,
               l_orderkey AS encounter_id, l_linenumber AS line,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS billing_amount,
               l_returnflag AS insurance, l_linestatus AS payment_status
        FROM lineitem""",
    "providers": """
        SELECT s_suppkey AS provider_id, s_name AS provider_name, r_name AS specialty, n_name AS location,
               s_nationkey AS experience_years,
               row_number() OVER (ORDER BY s_suppkey) AS provider_sk
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                      LEFT JOIN region ON n_regionkey = r_regionkey""",
    "catalog": """
        SELECT user_id AS patient_id, event_type AS cancer_type,
               CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS icd_code,
               CASE WHEN value < 5 THEN 'I' WHEN value < 15 THEN 'II' WHEN value < 40 THEN 'III' ELSE 'IV' END AS stage,
               props AS description, event_id AS tumor_markers
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn
              FROM events)
        WHERE rn = 1""",
    "dim_patients": f"""
        SELECT *, sha256(concat_ws('||', coalesce(patient_name, ''), coalesce(gender, ''),
                      coalesce(CAST(bmi AS VARCHAR), ''), coalesce(smoking_status, ''),
                      coalesce(CAST(age AS VARCHAR), ''))) AS record_hash,
               row_number() OVER (ORDER BY patient_id) AS patient_sk,
               '{T0}' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current
        FROM patients""",
    "dim_catalog": f"""
        SELECT *, sha256(concat_ws('||', coalesce(icd_code, ''), coalesce(stage, ''),
                      coalesce(description, ''), coalesce(CAST(tumor_markers AS VARCHAR), ''))) AS record_hash,
               row_number() OVER (ORDER BY patient_id, cancer_type) AS cancer_sk,
               '{T0}' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current
        FROM catalog""",
    "incoming": """
        SELECT *, sha256(concat_ws('||', coalesce(patient_name, ''), coalesce(gender, ''),
                      coalesce(CAST(bmi AS VARCHAR), ''), coalesce(smoking_status, ''),
                      coalesce(CAST(age AS VARCHAR), ''))) AS record_hash
        FROM patients_next""",
    "unchanged": """
        SELECT o.* FROM dim_patients o JOIN incoming n USING (patient_id) WHERE o.record_hash = n.record_hash""",
    "expired": f"""
        SELECT o.* REPLACE ('{T1}' AS valid_to, false AS is_current)
        FROM dim_patients o JOIN incoming n USING (patient_id) WHERE o.record_hash <> n.record_hash""",
    "carried": """
        SELECT o.* FROM dim_patients o ANTI JOIN incoming n USING (patient_id)""",
    "new_versions": f"""
        SELECT n.*, (SELECT max(patient_sk) FROM dim_patients) + row_number() OVER (ORDER BY n.patient_id) AS patient_sk,
               '{T1}' AS valid_from, CAST(NULL AS VARCHAR) AS valid_to, true AS is_current
        FROM incoming n LEFT JOIN dim_patients o USING (patient_id)
        WHERE o.record_hash IS NULL OR o.record_hash <> n.record_hash""",
    "merged": """
        SELECT * FROM unchanged UNION ALL BY NAME SELECT * FROM expired
        UNION ALL BY NAME SELECT * FROM carried UNION ALL BY NAME SELECT * FROM new_versions""",
    "assigned": """
        SELECT e.encounter_id, p.provider_sk, p.provider_id
        FROM encounters e
        LEFT JOIN providers p
          ON p.provider_sk - 1 = CAST('0x' || substr(sha256(CAST(e.encounter_id AS VARCHAR)), 1, 15) AS BIGINT)
                                 % (SELECT count(*) FROM providers)""",
    "rotated": """
        SELECT e.encounter_id, p.provider_sk, p.provider_id
        FROM (SELECT encounter_id, row_number() OVER (ORDER BY encounter_id) - 1 AS pos FROM encounters) e
        LEFT JOIN providers p ON p.provider_sk - 1 = e.pos % (SELECT count(*) FROM providers)""",
    "fact_one": """
        SELECT e.encounter_id, p.patient_sk, c.cancer_sk, a.provider_sk, a.provider_id,
               CAST(strftime(e.encounter_date, '%Y%m%d') AS INTEGER) AS date_sk,
               e.patient_id, e.encounter_date, e.treatment, e.drug_regimen, e.number_of_cycles,
               e.treatment_response_score, e.outcome, b.billing_id, b.billing_amount, b.insurance, b.payment_status
        FROM encounters e
        LEFT JOIN dim_patients p ON e.patient_id = p.patient_id
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY cancer_type) AS rn FROM dim_catalog) c
               ON e.patient_id = c.patient_id AND c.rn = 1
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY encounter_id
                          ORDER BY billing_id, billing_amount, insurance, payment_status) AS rn FROM billing) b
               ON e.encounter_id = b.encounter_id AND b.rn = 1
        LEFT JOIN assigned a ON e.encounter_id = a.encounter_id""",
    "fact_all": """
        SELECT e.encounter_id, p.patient_sk, c.cancer_sk, a.provider_sk, a.provider_id,
               CAST(strftime(e.encounter_date, '%Y%m%d') AS INTEGER) AS date_sk,
               e.patient_id, e.encounter_date, e.treatment, e.drug_regimen, e.number_of_cycles,
               e.treatment_response_score, e.outcome, b.billing_id, b.billing_amount, b.insurance, b.payment_status
        FROM encounters e
        LEFT JOIN dim_patients p ON e.patient_id = p.patient_id
        LEFT JOIN dim_catalog c ON e.patient_id = c.patient_id
        LEFT JOIN billing b ON e.encounter_id = b.encounter_id
        LEFT JOIN assigned a ON e.encounter_id = a.encounter_id""",
}

OVERVIEW = """
        SELECT f.encounter_id, f.encounter_date, f.treatment, f.drug_regimen, f.number_of_cycles,
               f.treatment_response_score, f.outcome, f.billing_amount, f.insurance, f.payment_status,
               f.provider_id, d.provider_name, d.specialty AS provider_specialty, d.location AS provider_location,
               p.patient_id, p.patient_name, p.gender, p.age, p.smoking_status, c.cancer_type, c.stage
        FROM {fact} f
        LEFT JOIN dim_patients p ON f.patient_sk = p.patient_sk
        LEFT JOIN dim_catalog c ON f.cancer_sk = c.cancer_sk
        LEFT JOIN providers d ON f.provider_sk = d.provider_sk"""


def cents(column: str) -> str:
    return f"CAST(sum({column}) * 100 AS HUGEINT)"


def average(column: str, weight: str = "") -> str:
    """Mean of a decimal(18,2) rounded half up to six places, in whole millionths."""
    n = weight or f"count({column})"
    return f"((2 * {cents(column)} * 10000 + {n}) // (2 * {n}))"


def as_mean(millionths: str) -> str:
    return f"CAST({millionths} AS DOUBLE) / 1000000"


PERFORMANCE = f"""
        SELECT f.provider_id, d.provider_name, d.specialty, d.location,
               count(DISTINCT f.encounter_id) AS encounter_count, count(DISTINCT f.patient_id) AS patient_count,
               {average("f.treatment_response_score")} AS score_millionths,
               sum(f.billing_amount) AS total_billing_amount,
               {average("f.billing_amount")} AS billing_millionths
        FROM {{fact}} f LEFT JOIN providers d ON f.provider_sk = d.provider_sk
        GROUP BY 1, 2, 3, 4"""

FINANCIAL = f"""
        SELECT CAST(encounter_date AS VARCHAR) AS encounter_date, treatment, insurance, payment_status,
               count(DISTINCT encounter_id) AS encounter_count,
               CAST(sum(billing_amount) AS DOUBLE) AS total_billing_amount,
               {as_mean(average("billing_amount"))} AS avg_billing_amount
        FROM {{fact}} GROUP BY 1, 2, 3, 4"""

CTES |= {
    "from_files": """
       SELECT e.*, b.billing_amount, b.insurance, b.payment_status, c.cancer_type, c.stage, p.patient_name,
              p.gender, p.age, p.smoking_status, o.provider_id, d.provider_name,
              d.specialty AS provider_specialty, d.location AS provider_location
       FROM encounters e
       LEFT JOIN rotated o ON e.encounter_id = o.encounter_id
       LEFT JOIN providers d ON o.provider_sk = d.provider_sk
       LEFT JOIN billing b ON e.encounter_id = b.encounter_id AND b.line % 3 <> 0
       LEFT JOIN catalog c ON e.patient_id = c.patient_id
       LEFT JOIN patients p ON e.patient_id = p.patient_id""",
    "overview_one": OVERVIEW.format(fact="fact_one"),
    "overview_all": OVERVIEW.format(fact="fact_all"),
    "performance_one": PERFORMANCE.format(fact="fact_one"),
    "performance_all": PERFORMANCE.format(fact="fact_all"),
    "filtered": """
        SELECT * FROM overview_one
        WHERE treatment IN ('1-URGENT', '2-HIGH') AND payment_status IN ('F')
          AND encounter_date BETWEEN
              (SELECT greatest(min(encounter_date), CAST(max(encounter_date) - INTERVAL 6 MONTH AS DATE)) FROM encounters)
              AND (SELECT max(encounter_date) FROM encounters)""",
}


def with_ctes(body: str) -> str:
    """Prefix the CTEs; an engine ignores those a query does not reach."""
    listed = ",\n    ".join(f"{name} AS ({text})" for name, text in CTES.items())
    return f"WITH {listed}\n{body}"


SHOW_OVERVIEW = """SELECT * REPLACE (CAST(encounter_date AS VARCHAR) AS encounter_date,
       CAST(treatment_response_score AS DOUBLE) AS treatment_response_score,
       CAST(billing_amount AS DOUBLE) AS billing_amount) FROM {}"""
SHOW_PERFORMANCE = f"""SELECT provider_id, provider_name, specialty, location, encounter_count, patient_count,
       {as_mean("score_millionths")} AS avg_treatment_response_score,
       CAST(total_billing_amount AS DOUBLE) AS total_billing_amount,
       {as_mean("billing_millionths")} AS avg_billing_amount FROM {{}}"""
SHOW_DIM = "SELECT * REPLACE (CAST(bmi AS DOUBLE) AS bmi) FROM {}"
SHOW_KPI = f"""SELECT count(DISTINCT encounter_id) AS encounters, count(DISTINCT patient_id) AS patients,
       CAST(coalesce(sum(billing_amount), 0) AS DOUBLE) AS revenue,
       {as_mean(average("billing_amount"))} AS avg_billing,
       {as_mean(average("billing_amount", "count(*)"))} AS avg_billing_zero_filled FROM {{}}"""
SHOW_DQ = """SELECT 'Missing billing amount' AS check_name, count(*) FILTER (billing_amount IS NULL) AS rows FROM {0}
UNION ALL SELECT 'Missing encounter date', count(*) FILTER (encounter_date IS NULL) FROM {0}
UNION ALL SELECT 'Duplicate encounter ids',
       count(*) - count(DISTINCT encounter_id) - coalesce(max(CAST(encounter_id IS NULL AS INTEGER)), 0) FROM {0}"""
PRESETS = {
    "Past Week": "7 DAY",
    "Past Month": "1 MONTH",
    "Past 3 Months": "3 MONTH",
    "Past 6 Months": "6 MONTH",
    "Past Year": "12 MONTH",
    "Past 2 Years": "24 MONTH",
}
BOUNDS = "(SELECT min(encounter_date) AS lo, max(encounter_date) AS hi FROM encounters)"


def window_sql(preset: str, start: str, end: str = "hi") -> str:
    first = f"greatest(lo, least({start}, hi))"
    shown = {
        "min_date": "lo",
        "max_date": "hi",
        "start_date": first,
        "end_date": f"greatest({first}, least({end}, hi))",
    }
    columns = ", ".join(f"CAST(CAST({e} AS DATE) AS VARCHAR) AS {name}" for name, e in shown.items())
    return f"SELECT {columns}, '{preset}' AS preset FROM {BOUNDS}"


def profile_sql(relation: str, columns: list[str]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count, "
        f"count(DISTINCT {c}) AS distinct_count, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM {relation}"
        for c in columns
    )


def group_sql(group: str, measure: str, name: str, rows: str = "overview_one") -> str:
    return f"SELECT {group}, {measure} AS {name} FROM {rows} WHERE {group} IS NOT NULL GROUP BY {group}"


REVENUE = "CAST(coalesce(sum(billing_amount), 0) AS DOUBLE)"
LABELLED = "(SELECT * FROM documents LEFT JOIN labels USING (doc_id))"
LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate"""
REJECTED = "FROM bronze_flagged WHERE reject_reasons <> ''"


def _prefixed(column: str) -> str:
    """The column's value as a length-prefixed text, ``-`` for NULL."""
    text = f"CAST({column} AS VARCHAR)"
    return f"coalesce(CAST(length({text}) AS VARCHAR) || ':' || {text}, '-')"


SHOW_FILE = """SELECT CAST(c_custkey AS VARCHAR) AS customer_key, replace(c_name, '#', chr(10)) AS customer_name,
       c_mktsegment AS segment, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS balance,
       CAST(NULL AS VARCHAR) AS malformed_record FROM customer"""

ORACLES = {
    "trim_strings": """SELECT c_custkey, trim('  ' || c_name || ' ') AS c_name,
       trim(c_mktsegment || '   ') AS c_mktsegment FROM customer""",
    "clean_names": r"""SELECT c_custkey, regexp_replace(
       c_name || CASE WHEN c_custkey % 2 = 0 THEN ' 12' ELSE ' 1 2' END, '\s\d+$', '') AS c_name FROM customer""",
    "typed_silver": """SELECT * REPLACE (CAST(encounter_date AS VARCHAR) AS encounter_date,
       CAST(treatment_response_score AS DOUBLE) AS treatment_response_score) FROM typed_encounters""",
    "bronze_rejects": f"SELECT *, 'Missing required field' AS reject_reason {REJECTED}",
    "silver_rejects": """SELECT * REPLACE (CAST(encounter_date AS VARCHAR) AS encounter_date,
       CAST(treatment_response_score AS DOUBLE) AS treatment_response_score) FROM (
       SELECT *, concat_ws('; ', CASE WHEN encounter_id IS NULL THEN 'encounter_id invalid' END,
                           CASE WHEN patient_id IS NULL THEN 'patient_id invalid' END,
                           CASE WHEN encounter_date IS NULL THEN 'encounter_date invalid' END) AS reject_reasons,
              'Silver validation failed' AS reject_reason FROM typed_encounters) WHERE reject_reasons <> ''""",
    "valid_reject_split": """SELECT encounter_id,
       CASE WHEN reject_reasons = '' THEN 'valid' ELSE 'rejected' END AS outcome_of_split FROM bronze_flagged""",
    "audit_counts": """SELECT 'raw_to_bronze' AS pipeline_step, 'encounters' AS table_name,
       count(*) + count(*) FILTER (outcome = 'P') AS source_count,
       count(*) FILTER (reject_reasons = '') AS valid_count,
       count(*) FILTER (reject_reasons <> '') AS reject_count,
       count(*) FILTER (outcome = 'P') AS duplicate_count FROM bronze_flagged""",
    "reject_payload_json": f"""SELECT '20210101000000' AS pipeline_run_id, 'raw_to_bronze' AS pipeline_step,
       'encounters' AS table_name, 'Missing required field' AS reject_reason, reject_reasons,
       '2021-01-01 00:00:00' AS rejected_at,
       '{{' || concat_ws(',', {", ".join(
           f"'\"{c}\":\"' || {c} || '\"'" for c in (
               "encounter_id", "patient_id", "date", "treatment", "drug_regimen", "number_of_cycles",
               "treatment_response_score", "outcome"))}) || '}}' AS record_payload {REJECTED}""",
    "profile_columns": profile_sql(LABELLED, ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]),
    "dedupe_exact": f"SELECT DISTINCT {LINE_COLUMNS} FROM lineitem",
    "dedupe_by_key": f"""SELECT {LINE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
       ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
    "latest_per_key": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn
             FROM events) WHERE rn = 1""",
    "first_catalog_per_patient": """SELECT patient_id, cancer_type, stage FROM (
       SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY cancer_type) AS rn FROM catalog) WHERE rn = 1""",
    "record_hash": "SELECT patient_id, record_hash FROM dim_patients",
    "record_hash_null_safe": f"""SELECT doc_id, sha256({_prefixed("lang")} || {_prefixed("quality")}
       || {_prefixed("toxic")}) AS record_hash FROM {LABELLED}""",
    "surrogate_keys": """SELECT c_mktsegment, c_custkey,
       row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS customer_sk FROM customer""",
    "surrogate_keys_lines": """SELECT l_orderkey, l_linenumber,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS line_sk FROM lineitem""",
    "csv_by_header": SHOW_FILE,
    "csv_by_position": SHOW_FILE,
    "dim_patients_stage": """SELECT patient_id, patient_name, gender, CAST(bmi AS DOUBLE) AS bmi, smoking_status, age,
       record_hash FROM dim_patients""",
    "dim_patients_seed": SHOW_DIM.format("dim_patients"),
    "dim_cancer_catalog": "SELECT * FROM dim_catalog",
    "dim_providers": "SELECT * FROM providers",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS VARCHAR) AS encounter_date,
       CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(quarter(d) AS INTEGER) AS quarter
       FROM (SELECT DISTINCT encounter_date AS d FROM encounters WHERE encounter_date IS NOT NULL)""",
    "scd2_merge": SHOW_DIM.format("merged"),
    "scd2_close_missing": f"""SELECT * REPLACE (CAST(bmi AS DOUBLE) AS bmi) FROM (
       SELECT * FROM unchanged UNION ALL BY NAME SELECT * FROM expired
       UNION ALL BY NAME SELECT * REPLACE ('{T1}' AS valid_to, false AS is_current) FROM carried
       UNION ALL BY NAME SELECT * FROM new_versions)""",
    "dim_current": SHOW_DIM.format("merged") + " WHERE is_current",
    "scd2_expired": SHOW_DIM.format("expired"),
    "scd2_carry_forward": SHOW_DIM.format("carried"),
    "scd2_unchanged": SHOW_DIM.format("unchanged"),
    "scd2_new_versions": SHOW_DIM.format("new_versions"),
    "scd2_delta_apply": SHOW_DIM.format("merged"),
    "scd2_delta_closed": SHOW_DIM.format("expired"),
    "scd2_history_merged": SHOW_DIM.format(
        f"""(SELECT * FROM expired UNION ALL BY NAME
             SELECT n.* REPLACE ('{T2}' AS valid_to, false AS is_current)
             FROM new_versions n JOIN dim_patients o USING (patient_id) WHERE n.record_hash <> o.record_hash)"""
    ),
    "lineage_columns": """SELECT CAST(c_custkey AS VARCHAR) AS customer_key, '20210101000000' AS pipeline_run_id,
       '2021-01-01 00:00:00' AS ingested_at, true AS from_csv FROM customer""",
    "csv_export": """SELECT substr(CAST(patient_id AS VARCHAR), 1, 3) || '****' AS patient_id,
       'REDACTED' AS patient_name, gender, CAST(bmi AS VARCHAR) AS bmi, smoking_status, CAST(age AS VARCHAR) AS age
       FROM patients""",
    "latest_load": """SELECT * REPLACE (CAST(encounter_date AS VARCHAR) AS encounter_date,
       CAST(treatment_response_score AS DOUBLE) AS treatment_response_score) FROM encounters""",
    "scan_if_loaded": "SELECT 'there' AS table_name, encounter_id FROM encounters",
    "audit_newest_first": """SELECT run_id AS pipeline_run_id, 'raw_to_bronze' AS pipeline_step, table_name,
       CAST(NULL AS BIGINT) AS source_count, CAST(NULL AS BIGINT) AS valid_count, CAST(NULL AS BIGINT) AS reject_count,
       CAST(NULL AS BIGINT) AS duplicate_count, row_count, 'SUCCESS' AS status, recorded_at
       FROM (SELECT 'customer' AS table_name, count(*) AS row_count FROM customer
             UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem),
            (VALUES ('9', '2020-01-01 00:00:00'), ('10', '2021-01-01 00:00:00')) AS v(run_id, recorded_at)""",
    "latest_run": """SELECT max(run_id) AS pipeline_run_id, count(run_id) AS row_count FROM (
       SELECT CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y%m%d') END AS run_id FROM orders)""",
    "named_views": """SELECT 'patients' AS of_view, gender AS name, count(*) AS n FROM merged WHERE is_current GROUP BY 2
       UNION ALL SELECT 'catalog', stage, count(*) FROM dim_catalog GROUP BY 2
       UNION ALL SELECT 'providers', specialty, count(*) FROM providers GROUP BY 2""",
    "audit_observed": """SELECT 'raw_to_bronze' AS pipeline_step, 'encounters' AS table_name, count(*) AS source_count,
       count(*) FILTER (reject_reasons = '') AS valid_count, count(*) FILTER (reject_reasons <> '') AS reject_count
       FROM bronze_flagged""",
    "profile_merged": "\nUNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
       CAST({f'min({c})' if number else 'NULL'} AS DOUBLE) AS min_number,
       CAST({f'max({c})' if number else 'NULL'} AS DOUBLE) AS max_number,
       {'CAST(NULL AS VARCHAR)' if number else f'min({c})'} AS min_text, true AS within_5_percent FROM documents"""
        for c, number in (("doc_id", True), ("text", False), ("lang", False), ("source", False), ("n_chars", True))
    ),
    "fact_from_buckets": "SELECT encounter_id, patient_sk, cancer_sk FROM fact_one",
    "masked_view_analyst": """SELECT substr(CAST(patient_id AS VARCHAR), 1, 3) || '****' AS patient_id,
       'REDACTED' AS patient_name, gender, CAST(bmi AS DOUBLE) AS bmi, smoking_status, age FROM patients""",
    "masked_view_admin": """SELECT CAST(patient_id AS VARCHAR) AS patient_id, patient_name, gender,
       CAST(bmi AS DOUBLE) AS bmi, smoking_status, age FROM patients""",
    "preview_rows": """SELECT * REPLACE (CAST(encounter_date AS VARCHAR) AS encounter_date,
       CAST(treatment_response_score AS DOUBLE) AS treatment_response_score)
       FROM (SELECT * FROM encounters ORDER BY encounters.encounter_date, encounter_id LIMIT 25)""",
    "column_fallback": "SELECT c_custkey, c_name, c_mktsegment, c_name AS patient_name FROM customer",
    "manifest_read": """SELECT 1 AS sequence, 'run-9' AS run_id, 'patients' AS table_name, patient_id AS id FROM patients
       UNION ALL SELECT 1, 'run-9', 'encounters', encounter_id FROM encounters WHERE outcome = 'F'
       UNION ALL SELECT 2, 'run-10', 'patients', patient_id FROM patients_next
       UNION ALL SELECT 2, 'run-10', 'encounters', encounter_id FROM encounters""",
    "provider_assignment": "SELECT * FROM assigned",
    "provider_round_robin": "SELECT * FROM rotated",
    "fact_date_key": """SELECT encounter_id, CAST(encounter_date AS VARCHAR) AS encounter_date,
       CAST(strftime(encounter_date, '%Y%m%d') AS INTEGER) AS date_sk FROM encounters""",
    "fact_encounters_one": SHOW_OVERVIEW.format("fact_one"),
    "fact_encounters_all": SHOW_OVERVIEW.format("fact_all"),
    "fact_encounters_all_split": SHOW_OVERVIEW.format("fact_all"),
    "fact_encounters_one_split": SHOW_OVERVIEW.format("fact_one"),
    "bridge_encounter_provider": """SELECT encounter_id, provider_sk, provider_id,
       'HASH_ENCOUNTER_PROVIDER_ASSIGNMENT' AS assignment_method FROM assigned WHERE provider_sk IS NOT NULL""",
    "encounter_overview": SHOW_OVERVIEW.format("overview_one"),
    "encounter_overview_all": SHOW_OVERVIEW.format("overview_all"),
    "financial_analytics": FINANCIAL.format(fact="fact_one"),
    "financial_analytics_all": FINANCIAL.format(fact="fact_all"),
    "provider_performance": SHOW_PERFORMANCE.format("performance_one"),
    "provider_performance_all": SHOW_PERFORMANCE.format("performance_all"),
    "overview_two_key_join": SHOW_OVERVIEW.format("from_files"),
    "financial_from_files": FINANCIAL.format(
        fact="""from_files WHERE encounter_date IS NOT NULL AND treatment IS NOT NULL AND insurance IS NOT NULL
            AND payment_status IS NOT NULL"""
    ),
    "provider_from_files": SHOW_PERFORMANCE.format(f"""(
        SELECT provider_id, provider_name, provider_specialty AS specialty, provider_location AS location,
               count(DISTINCT encounter_id) AS encounter_count, count(DISTINCT patient_id) AS patient_count,
               {average("treatment_response_score")} AS score_millionths,
               sum(billing_amount) AS total_billing_amount,
               {average("billing_amount")} AS billing_millionths
        FROM from_files
        WHERE provider_id IS NOT NULL AND provider_name IS NOT NULL AND provider_specialty IS NOT NULL
          AND provider_location IS NOT NULL
        GROUP BY 1, 2, 3, 4)"""),
    "monthly_encounters": """SELECT CAST(CAST(date_trunc('month', encounter_date) AS DATE) AS VARCHAR) AS month_start,
       count(DISTINCT encounter_id) AS encounter_count FROM overview_one GROUP BY 1""",
    "stage_revenue": """SELECT stage, CAST(sum(billing_amount) AS DOUBLE) AS total_revenue
       FROM overview_one GROUP BY stage""",
    "provider_ranking": """SELECT provider_name, specialty, encounter_count,
       CAST(total_billing_amount AS DOUBLE) AS total_billing_amount FROM performance_one""",
    "metric_by_stage": f"""SELECT stage AS cancer_stage, treatment, count(DISTINCT encounter_id) AS encounter_count,
       CAST(sum(billing_amount) AS DOUBLE) AS total_billing_amount,
       {as_mean(average("billing_amount"))} AS avg_billing_amount FROM overview_one GROUP BY 1, 2""",
    "metric_provider_rollup": """SELECT specialty, CAST(sum(encounter_count) AS BIGINT) AS encounter_count,
       CAST(sum(patient_count) AS BIGINT) AS patient_count,
       CAST((2 * sum(score_millionths) * 10000 + count(score_millionths)) // (2 * count(score_millionths)) AS DOUBLE)
           / 10000000000 AS avg_treatment_response_score,
       CAST(sum(total_billing_amount) AS DOUBLE) AS total_billing_amount FROM performance_one GROUP BY 1""",
    "metric_provider_exact": f"""SELECT provider_specialty AS specialty, count(DISTINCT encounter_id) AS encounter_count,
       count(DISTINCT patient_id) AS patient_count,
       {as_mean(average("treatment_response_score"))} AS avg_treatment_response_score,
       CAST(sum(billing_amount) AS DOUBLE) AS total_billing_amount
       FROM overview_one GROUP BY 1""",
    "metric_provider_exact_filtered": f"""SELECT provider_specialty AS specialty, count(DISTINCT encounter_id) AS encounter_count,
       count(DISTINCT patient_id) AS patient_count,
       {as_mean(average("treatment_response_score"))} AS avg_treatment_response_score,
       CAST(sum(billing_amount) AS DOUBLE) AS total_billing_amount
       FROM overview_one WHERE outcome <> 'P' GROUP BY 1""",
    "filtered_overview": SHOW_OVERVIEW.format("filtered"),
    "date_preset_window": "\nUNION ALL ".join(
        [window_sql("All Data", "lo")]
        + [window_sql(p, f"CAST(hi - INTERVAL {back} AS DATE)") for p, back in PRESETS.items()]
        + [window_sql("Requested", "DATE '1900-01-01'", "DATE '1997-06-30'")]
    ),
    "date_preset_from_footers": "\nUNION ALL ".join(
        [window_sql("All Data", "lo")]
        + [window_sql(p, f"CAST(hi - INTERVAL {back} AS DATE)") for p, back in PRESETS.items()]
        + [window_sql("Requested", "DATE '1900-01-01'", "DATE '1997-06-30'")]
    ),
    "filter_values": "\nUNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS filter_name, {c} AS value FROM overview_one WHERE {c} IS NOT NULL"
        for c in ("treatment", "stage", "payment_status")
    ),
    "kpi_summary": SHOW_KPI.format("filtered"),
    "kpi_summary_unfiltered": SHOW_KPI.format("overview_one"),
    "top_providers_by_encounters": SHOW_PERFORMANCE.format("performance_one")
    + " ORDER BY encounter_count DESC NULLS LAST, provider_id LIMIT 15",
    "top_providers_by_response": SHOW_PERFORMANCE.format("performance_one")
    + " ORDER BY score_millionths DESC NULLS LAST, provider_id LIMIT 15",
    "mask_patients": """SELECT substr(CAST(patient_id AS VARCHAR), 1, 3) || '****' AS patient_id,
       'REDACTED' AS patient_name, gender, CAST(bmi AS DOUBLE) AS bmi,
       smoking_status, age, patient_id AS row_key FROM patients""",
    "mask_catalog": """SELECT * REPLACE (substr(CAST(patient_id AS VARCHAR), 1, 3) || '****' AS patient_id),
       patient_id AS row_key FROM catalog""",
    "mask_patients_pattern": r"""SELECT regexp_replace(CAST(patient_id AS VARCHAR), '(^...).*', '\1****') AS patient_id,
       'REDACTED' AS patient_name, gender, CAST(bmi AS DOUBLE) AS bmi,
       smoking_status, age, patient_id AS row_key FROM patients""",
    "mask_patients_privileged": SHOW_DIM.format("patients"),
    "dq_summary": SHOW_DQ.format("overview_all"),
    "dq_summary_filtered": SHOW_DQ.format("filtered"),
}

ORACLES |= {
    "metric_provider_rollup_exact": ORACLES["metric_provider_exact"],
    "kpi_from_rollup": ORACLES["kpi_summary_unfiltered"],
    "monthly_from_rollup": """SELECT strftime(encounter_date, '%Y-%m') AS month,
       count(DISTINCT encounter_id) AS encounter_count FROM overview_one WHERE encounter_date IS NOT NULL GROUP BY 1""",
    "stage_patients_from_rollup": """SELECT stage, count(DISTINCT patient_id) AS patient_count FROM overview_one
       WHERE encounter_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND stage IS NOT NULL GROUP BY 1""",
}


def bundle_sql(rows: str) -> str:
    """Each report's measures by itself."""
    measures = f"""count(*) AS row_count, count(DISTINCT encounter_id) AS encounter_count,
       count(DISTINCT patient_id) AS patient_count, {REVENUE} AS revenue,
       {as_mean(average("billing_amount"))} AS avg_billing,
       {as_mean(average("billing_amount", "count(*)"))} AS avg_billing_zero_filled,
       {as_mean(average("treatment_response_score"))} AS avg_treatment_response_score,
       count(*) FILTER (billing_amount IS NULL) AS missing_amounts,
       count(*) FILTER (encounter_date IS NULL) AS missing_dates,
       coalesce(max(CAST(encounter_id IS NULL AS BIGINT)), 0) AS missing_ids"""
    groups = {
        "monthly_trend": "strftime(encounter_date, '%Y-%m')",
        "treatment_mix": "treatment",
        "stage_distribution": "stage",
        "revenue_by_payer": "insurance",
        "payment_status_mix": "payment_status",
    }
    parts = [f"SELECT 'overall' AS report, CAST(NULL AS VARCHAR) AS group_value, {measures} FROM {rows}"]
    parts += [
        f"SELECT '{name}', {group} AS g, {measures} FROM {rows} WHERE {group} IS NOT NULL GROUP BY g"
        for name, group in groups.items()
    ]
    return "\nUNION ALL ".join(parts)


for rows, suffix in (("overview_one", ""), ("filtered", "_filtered")):
    ORACLES |= {
        f"report_bundle{suffix}": bundle_sql(rows),
        f"monthly_trend{suffix}": f"""SELECT strftime(encounter_date, '%Y-%m') AS month,
       count(DISTINCT encounter_id) AS encounter_count FROM {rows} WHERE encounter_date IS NOT NULL GROUP BY 1""",
        f"treatment_mix{suffix}": group_sql("treatment", "count(DISTINCT encounter_id)", "encounter_count", rows),
        f"stage_distribution{suffix}": group_sql("stage", "count(DISTINCT patient_id)", "patient_count", rows),
        f"response_by_treatment{suffix}": group_sql(
            "treatment", as_mean(average("treatment_response_score")), "treatment_response_score", rows
        ),
        f"revenue_by_payer{suffix}": group_sql("insurance", REVENUE, "billing_amount", rows),
        f"payment_status_mix{suffix}": group_sql("payment_status", REVENUE, "billing_amount", rows),
        f"governance_slice{suffix}": f"""SELECT patient_name, gender, age, smoking_status, cancer_type, stage, treatment,
       CAST(billing_amount AS DOUBLE) AS amount,
       substr(CAST(patient_id AS VARCHAR), 1, 3) || '****' AS patient_id_masked FROM {rows}""",
    }

ORACLES = {name: with_ctes(body) for name, body in ORACLES.items()}
