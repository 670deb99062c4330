"""Date keys and report date windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The report presets, as (months back, days back).
PRESETS: dict[str, tuple[int, int] | None] = {
    "All Data": None,
    "Past Week": (0, 7),
    "Past Month": (1, 0),
    "Past 3 Months": (3, 0),
    "Past 6 Months": (6, 0),
    "Past Year": (12, 0),
    "Past 2 Years": (24, 0),
}


def date_key(day: Column) -> Column:
    """The date as the integer yyyyMMdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_label(day: Column) -> Column:
    """The month as ``yyyy-MM``, which sorts like the dates in it."""
    return F.date_format(day, "yyyy-MM")


def preset_start(preset: str, lower: Column, upper: Column) -> Column:
    """First day of a preset that ends on ``upper`` and never begins before ``lower``."""
    if preset not in PRESETS:
        raise ValueError(f"unknown preset {preset!r}; expected one of {list(PRESETS)}")
    back = PRESETS[preset]
    if back is None:
        return lower
    months, days = back
    return F.greatest(lower, F.date_sub(F.add_months(upper, -months), days))


def clamp_window(start: Column, end: Column, lower: Column, upper: Column) -> tuple[Column, Column]:
    """Bring a requested window inside the data bounds, keeping start <= end."""
    first = F.greatest(lower, F.least(start, upper))
    return first, F.greatest(first, F.least(end, upper))
