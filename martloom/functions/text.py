"""Cleaning of text columns and tolerant parsing of text-typed numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def clean(col: Column) -> Column:
    return F.trim(col)


def clean_lower(col: Column) -> Column:
    return F.lower(F.trim(col))


def parse_decimal(col: Column, to: str = MONEY) -> Column:
    """Decimal-comma text to a decimal; unreadable text becomes NULL instead of failing the load.

    A dot is a thousands separator only when a comma follows it, so ``1.234,56`` and
    ``1234.56`` both read as 1234.56, and ``1,234.56`` is unreadable rather than guessed.
    """
    text = F.trim(col.cast("string"))
    comma_form = F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    readable = F.when(~text.contains(","), text).when(~text.rlike(r",.*\."), comma_form)
    return readable.try_cast(to)


def parse_date(col: Column, fmt: str = "dd/MM/yyyy") -> Column:
    """Text date to DATE; unreadable text becomes NULL."""
    return F.try_to_date(F.trim(col), fmt)


def parse_failed(raw: Column, parsed: Column) -> Column:
    """True where there was text to read and reading it gave nothing."""
    return raw.isNotNull() & (F.trim(raw.cast("string")) != "") & parsed.isNull()


def decimal_comma_text(col: Column) -> Column:
    return F.replace(col.cast("string"), F.lit("."), F.lit(","))
