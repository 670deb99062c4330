"""Parsers that give NULL on bad input, under ANSI mode too."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field texts that mean NULL in the landing files.
NULL_TOKENS = ("NULL", "null", "")


def null_if_token(value: Column) -> Column:
    return F.when(~F.trim(value).isin(*NULL_TOKENS), value)


def parse_decimal(value: Column, precision: int, scale: int) -> Column:
    return value.try_cast(f"decimal({precision},{scale})")


def parse_integer(value: Column) -> Column:
    """Round to the nearest integer: ``'3.7'`` is 4, where a plain int cast gives NULL."""
    return value.try_cast("decimal(38,0)").try_cast("int")


def parse_date(value: Column) -> Column:
    return F.try_to_date(value)


def parse_as(value: Column, type_name: str) -> Column:
    """Parse text as ``int``, ``date``, ``decimal(p,s)`` or any other Spark type."""
    if type_name == "int":
        return parse_integer(value)
    if type_name == "date":
        return parse_date(value)
    return value.try_cast(type_name)
