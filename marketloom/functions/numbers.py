"""Numeric expressions: rounding, clamping, ratios and decay."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(value: Column, places: int) -> Column:
    """Half-even rounding in binary arithmetic, which stays in generated code (no decimals)."""
    scale = float(10**places)
    return F.rint(value.cast("double") * F.lit(scale)) / F.lit(scale)


def round6(value: Column) -> Column:
    return round_to(value, 6)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), value))


def clamp01(value: Column) -> Column:
    return clamp(value, 0.0, 1.0)


def ratio(part: Column, whole: Column, otherwise: float | None = 0.0) -> Column:
    """part / whole, or ``otherwise`` when the whole is missing or zero."""
    safe = F.when(whole != 0, part.cast("double") / whole.cast("double"))
    return safe if otherwise is None else F.coalesce(safe, F.lit(float(otherwise)))


def recency_decay(as_of: Column, last_seen: Column, days: float = 30.0) -> Column:
    """exp(-age / days) with the age in whole days, never negative."""
    age = F.greatest(F.lit(0), F.datediff(as_of, last_seen))
    return F.exp(-age.cast("double") / F.lit(days))


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0 (null counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
