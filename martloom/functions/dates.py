"""Calendar arithmetic. Everything stays DATE typed, so the session zone never matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names shown in the calendar and the finance metric view.
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)


def month_start(col: Column) -> Column:
    return F.trunc(col, "MM")


def year_month(col: Column) -> Column:
    """YYYYMM as an integer."""
    return F.year(col) * 100 + F.month(col)


def month_name(col: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in MONTH_NAMES]), F.month(col))


def first_day_of_year(col: Column) -> Column:
    return F.trunc(col, "YEAR")


def last_day_of_year(col: Column) -> Column:
    return F.date_sub(F.add_months(F.trunc(col, "YEAR"), 12), 1)
