"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.text import col

MONEY = "decimal(10,2)"


def money(c: str | Column) -> Column:
    """Float to DECIMAL(10,2), NULL to 0.00."""
    return F.coalesce(col(c).cast(MONEY), F.lit(0).cast(MONEY))


def whole(c: str | Column) -> Column:
    """Float to INT by truncation, NULL to 0."""
    return F.coalesce(col(c).cast("int"), F.lit(0))


def flag(c: str | Column) -> Column:
    return F.coalesce(col(c).cast("short"), F.lit(0).cast("short"))


def ratio(a: Column, b: Column) -> Column:
    """Division that gives NULL when the divisor is 0 or NULL."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def to_half(c: Column) -> Column:
    """Nearest 0.5, ties to even."""
    return F.rint(c * 2) / 2


def tier(c: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose inclusive lower bound is reached."""
    out = None
    for bound, label in steps:
        out = F.when(c >= bound, label) if out is None else out.when(c >= bound, label)
    return out.otherwise(otherwise)


def churn_tier(p: Column) -> Column:
    return tier(p, [(0.65, "High"), (0.40, "Medium")], "Low")


def delay_tier(p: Column) -> Column:
    return tier(p, [(0.40, "High"), (0.20, "Medium")], "Low")


def satisfaction(score: Column) -> Column:
    return tier(score, [(4.5, "Excellent"), (3.5, "Good"), (2.5, "Average")], "Poor")


def segment_name(mean_rank: Column) -> Column:
    return tier(mean_rank, [(3.5, "Champions"), (2.5, "Loyal"), (1.8, "At Risk")], "Lost/Inactive")


def rounded_prediction(p: Column) -> Column:
    return to_half(clip(p, 1.0, 5.0))
