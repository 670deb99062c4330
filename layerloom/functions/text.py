"""Header and string cleaning."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the trailing counter that is cut from person names.
NAME_COUNTER = r"\s\d+$"


def snake_case(header: str) -> str:
    """Lower-case the header and join its alphanumeric runs with ``_``."""
    return "_".join(re.findall("[a-z0-9]+", header.lower()))


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename every column; two headers that land on one name are an error."""
    names = [snake_case(header) for header in df.columns]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"headers {df.columns} collide after normalising: {clashes}")
    return df.toDF(*names)


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip spaces (not tabs) on both sides of every string column."""
    return df.withColumns(
        {f.name: F.trim(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    )


def strip_name_counter(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Remove one trailing `` <digits>`` from the named columns."""
    return df.withColumns({c: F.regexp_replace(c, NAME_COUNTER, "") for c in columns})


def alias_missing(df: DataFrame, fallbacks: dict[str, str]) -> DataFrame:
    """Add ``target`` as a copy of ``source`` for each target the frame lacks."""
    present = set(df.columns)
    return df.withColumns(
        {
            target: F.col(source)
            for target, source in fallbacks.items()
            if target not in present and source in present
        }
    )
