"""Run a registered query and its SQL, and compare them as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, Decimal)):
        f = float(v)
        return None if math.isnan(f) else f
    return str(v)


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """None when both sides agree in columns and rows."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    expected = _rows(names, cursor.fetchall())
    actual = _rows(spark_df.columns, [tuple(row) for row in spark_df.collect()])
    if actual == expected:
        return None
    extra, lacking = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; "
        f"only here {list(extra)[:3]}; only there {list(lacking)[:3]}"
    )
