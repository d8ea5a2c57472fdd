"""Seasonal availability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seasonal_flag(month: Column, start: Column, end: Column) -> Column:
    """1.0 inside the season, also for seasons that wrap over the year end.

    A start of 0 or null means January, an end of 0 or null means December.
    """
    first = F.coalesce(F.when(start != 0, start), F.lit(1))
    last = F.coalesce(F.when(end != 0, end), F.lit(12))
    inside = F.when(first <= last, month.between(first, last)).otherwise((month >= first) | (month <= last))
    return F.when(inside, F.lit(1.0)).otherwise(F.lit(0.0))
