"""Null-safe arithmetic shared by measures and analytics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double; NULL on a zero or missing denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def exact_avg(col: Column) -> Column:
    """Mean of a decimal column from its exact sum, so the result never depends on row order."""
    return F.sum(col).cast("double") / F.nullif(F.count(col).cast("double"), F.lit(0.0))
