from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.functions import dates, text
from martloom.functions.intent import question_intent
from martloom.functions.numbers import ratio


@pytest.mark.parametrize(
    ("raw", "value"),
    [
        ("1234,56", "1234.5600"),
        ("1.234,56", "1234.5600"),
        ("1.234.567,891", "1234567.8910"),
        ("1234.56", "1234.5600"),
        (" -7,5 ", "-7.5000"),
        ("$5", None),
        ("", None),
        (None, None),
        ("1,2,3", None),
        ("1,234.56", None),
    ],
)
def test_parse_decimal(spark, raw, value):
    df = spark.createDataFrame([(raw,)], "raw string")
    got = df.select(text.parse_decimal(F.col("raw")).alias("v")).first().v
    assert got == (Decimal(value) if value else None)


@pytest.mark.parametrize(
    ("raw", "value"),
    [("31/12/2024", date(2024, 12, 31)), ("2024-13-01", None), ("1/2/2024", None), ("", None), (None, None), ("30/02/2024", None)],
)
def test_parse_date(spark, raw, value):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert df.select(text.parse_date(F.col("raw")).alias("v")).first().v == value


def test_clean(spark):
    row = spark.createDataFrame([("  Ab ",)], "t string").select(
        text.clean(F.col("t")).alias("c"), text.clean_lower(F.col("t")).alias("l")
    ).first()
    assert (row.c, row.l) == ("Ab", "ab")


def test_ratio_guards_zero_and_null(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 2), (1, 4)], "a int, b int")
    got = [r.v for r in df.select(ratio(F.col("a"), F.col("b")).alias("v")).collect()]
    assert got == [None, None, None, 0.25]


def test_year_bounds_in_leap_year(spark):
    day = F.lit("2024-02-29").cast("date")
    row = spark.range(1).select(
        dates.first_day_of_year(day).alias("a"), dates.last_day_of_year(day).alias("b"), dates.month_name(day).alias("m")
    ).first()
    assert (row.a, row.b, row.m) == (date(2024, 1, 1), date(2024, 12, 31), "Fevereiro")


@pytest.mark.parametrize(
    ("question", "intent"),
    [
        ("Qual a PREVISÃO de vendas?", "forecast"),
        ("Por que a receita caiu?", "pvm"),
        ("O que fazer com os clientes At Risk?", "reco"),
        ("Qual o motivo da projeção menor?", "forecast"),
        ("Explica e recomenda", "pvm"),
        ("Qual a melhor ação?", "reco"),
        ("Vendas por região", None),
        ("", None),
    ],
)
def test_question_intent(spark, question, intent):
    df = spark.createDataFrame([(question,)], "q string")
    assert df.select(question_intent(F.col("q")).alias("i")).first().i == intent
