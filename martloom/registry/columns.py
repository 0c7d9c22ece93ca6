"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.functions import dates, text
from martloom.functions.numbers import ratio
from martloom.registry.core import Context, query


@query(
    "fn_text_clean",
    "SELECT c_custkey, c_name AS clean, lower(c_mktsegment) AS lowered FROM customer",
)
def fn_text_clean(c: Context):
    padded = lambda name: F.concat(F.lit("  "), F.col(name), F.lit(" "))
    return c.sample.read("customer").select(
        "c_custkey",
        text.clean(padded("c_name")).alias("clean"),
        text.clean_lower(padded("c_mktsegment")).alias("lowered"),
    )


@query(
    "fn_ptbr_number_date",
    "SELECT o_orderkey, o_totalprice AS comma, o_totalprice AS grouped, o_totalprice AS plain,"
    " CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed, CAST(NULL AS VARCHAR) AS unreadable FROM orders",
)
def fn_ptbr_number_date(c: Context):
    """Amounts written 1234,56 and 1.234,56 and 1234.56; dates written dd/MM/yyyy and yyyy-MM-dd."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    american = F.format_number(amount, 2)
    grouped = F.translate(american, ",.", ".,")
    day = F.col("o_orderdate").cast("date")
    return c.sample.read("orders").select(
        "o_orderkey",
        text.parse_decimal(text.decimal_comma_text(amount)).alias("comma"),
        text.parse_decimal(grouped).alias("grouped"),
        text.parse_decimal(amount.cast("string")).alias("plain"),
        text.parse_date(F.date_format(day, "dd/MM/yyyy")).alias("parsed"),
        text.parse_date(day.cast("string")).alias("unreadable"),
    )


@query(
    "fn_dates",
    """SELECT o_orderkey, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start, CAST(last_day(d) AS VARCHAR) AS month_end,
         CAST(CAST(d + INTERVAL 12 MONTH AS DATE) AS VARCHAR) AS next_year, CAST(CAST(date_trunc('year', d) AS DATE) AS VARCHAR) AS year_start,
         CAST(make_date(year(d), 12, 31) AS VARCHAR) AS year_end, CAST(year(d) * 100 + month(d) AS INTEGER) AS ym,
         CAST(weekofyear(d) AS INTEGER) AS week, CAST(dayofweek(d) + 1 AS INTEGER) AS weekday, CAST(quarter(d) AS INTEGER) AS quarter
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def fn_dates(c: Context):
    day = F.col("o_orderdate").cast("date")
    return c.sample.read("orders").select(
        "o_orderkey",
        dates.month_start(day).alias("month_start"),
        F.last_day(day).alias("month_end"),
        F.add_months(day, 12).alias("next_year"),
        dates.first_day_of_year(day).alias("year_start"),
        dates.last_day_of_year(day).alias("year_end"),
        dates.year_month(day).alias("ym"),
        F.weekofyear(day).alias("week"),
        F.dayofweek(day).alias("weekday"),
        F.quarter(day).alias("quarter"),
    )


@query(
    "fn_map_struct",
    "SELECT event_id, props ->> '$.k' AS tag, CAST(NULL AS VARCHAR) AS absent, value AS list_value FROM events",
)
def fn_map_struct(c: Context):
    tags = F.from_json("props", "map<string,string>")
    return (
        c.sample.read("events")
        .withColumn("custom_tags", tags)
        .withColumn("pricing", F.struct(F.col("value").alias("default")))
        .select(
            "event_id",
            F.col("custom_tags").getItem("k").alias("tag"),
            F.col("custom_tags").getItem("dominio").alias("absent"),
            F.col("pricing.default").alias("list_value"),
        )
    )


@query(
    "fn_null_safe",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_tax / nullif(l_discount, 0) AS share,
         coalesce(nullif(l_discount, 0), -1) AS discount, abs(l_discount - l_tax) AS gap FROM lineitem""",
)
def fn_null_safe(c: Context):
    return c.sample.read("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        ratio(F.col("l_tax"), F.col("l_discount")).alias("share"),
        F.coalesce(F.nullif(F.col("l_discount"), F.lit(0.0)), F.lit(-1.0)).alias("discount"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
    )
