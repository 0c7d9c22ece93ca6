"""The gold star schema: nine dimensions, four facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions import dates
from martloom.plans.contracts import CONTRACTS, apply_contract


def _declared(table: str, df: DataFrame, loaded_at: Column | None) -> DataFrame:
    return apply_contract(df, CONTRACTS[table], loaded_at)


def projection(table: str, silver: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Gold tables that only restate a silver table in declared order."""
    return _declared(table, silver, loaded_at)


def dim_geography(
    geography: DataFrame, region: DataFrame, loaded_at: Column | None = None
) -> DataFrame:
    joined = geography.join(region.select("region_key", "region_name", "continent"), "region_key", "left")
    return _declared("dim_geography", joined, loaded_at)


def dim_product(
    product: DataFrame, sub_category: DataFrame, loaded_at: Column | None = None
) -> DataFrame:
    names = sub_category.select("product_subcategory_key", "subcategory_name", "category_name")
    return _declared(
        "dim_product", product.join(names, "product_subcategory_key", "left"), loaded_at
    )


def _date_bounds(df: DataFrame, *columns: str) -> DataFrame:
    """Smallest and largest date over several columns in one scan."""
    return df.agg(
        F.least(*[F.min(c) for c in columns], F.lit(None).cast("date")).alias("low"),
        F.greatest(*[F.max(c) for c in columns], F.lit(None).cast("date")).alias("high"),
    )


def calendar_bounds(finance: DataFrame, header: DataFrame, returns: DataFrame) -> DataFrame:
    """One row: first day of the earliest fact year, last day of the latest."""
    ranges = [
        _date_bounds(finance, "transaction_date"),
        _date_bounds(header, "order_date", "due_date", "ship_date"),
        _date_bounds(returns, "return_date", "order_date"),
    ]
    return reduce(DataFrame.unionByName, ranges).agg(
        dates.first_day_of_year(F.min("low")).alias("start_date"),
        dates.last_day_of_year(F.max("high")).alias("end_date"),
    )


def calendar_attributes(day: Column) -> dict[str, Column]:
    """Everything the calendar says about a day; each is a function of the day alone."""
    return {
        "date_key": F.date_format(day, "yyyyMMdd").cast("int"),
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": dates.month_name(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def dim_calendar(
    finance: DataFrame, header: DataFrame, returns: DataFrame, loaded_at: Column | None = None
) -> DataFrame:
    days = (
        calendar_bounds(finance, header, returns)
        .filter(F.col("start_date").isNotNull())
        .select(
            F.explode(
                F.sequence("start_date", "end_date", F.expr("interval 1 day"))
            ).alias("full_date")
        )
    )
    return _declared(
        "dim_calendar", days.withColumns(calendar_attributes(F.col("full_date"))), loaded_at
    )


def _order_terms(header: DataFrame, *also: str) -> DataFrame:
    """What an order passes on to its lines, with its discount as a share of its total."""
    share = F.col("discount_amount") / F.nullif(F.col("total_amount"), F.lit(0))
    return header.select(
        "sales_header_key", "customer_key", "region_key", "order_date", "due_date", "ship_date",
        share.alias("_share"), *also,
    )


def _order_lines(details: DataFrame) -> DataFrame:
    return details.select(
        "sales_details_key", "sales_header_key", "product_key", "sales_order_number",
        "order_quantity", "unit_price", F.col("extended_amount").alias("gross_sales"),
    )


def _discount() -> Column:
    return F.col("_share") * F.col("gross_sales")


def fct_sales_details(
    details: DataFrame, header: DataFrame, loaded_at: Column | None = None
) -> DataFrame:
    """Order lines with the order's dates and buyer, and its discount spread by line amount.

    An order that is missing or totals zero has no discount share, so both the discount and the
    net amount of its lines are NULL while the gross amount stays.
    """
    return _declared(
        "fct_sales_details",
        _order_lines(details).join(_order_terms(header), "sales_header_key", "left").withColumns(
            {
                "discount_allocated": _discount().cast("decimal(18,4)"),
                "net_sales": (F.col("gross_sales") - _discount()).cast("decimal(18,4)"),
                "lead_time_days": F.date_diff("ship_date", "order_date"),
                "promised_lead_time_days": F.date_diff("due_date", "order_date"),
                "delivery_delay_days": F.date_diff("ship_date", "due_date"),
                "is_late": F.col("ship_date") > F.col("due_date"),
            }
        ),
        loaded_at,
    )


def sales_of_buyers(details: DataFrame, header: DataFrame, buyers: DataFrame) -> DataFrame:
    """Sales lines of known buyers with the buyer's attributes, for composing without stored facts.

    The same rows as joining the buyers to the sales fact, but each order finds its buyer before
    it meets its lines: orders shuffle by customer instead of lines, which are several times as many.
    """
    attributes = [c for c in buyers.columns if c != "customer_key"]
    orders = _order_terms(header.join(buyers, "customer_key"), *attributes)
    lines = _order_lines(details).filter(F.col("sales_details_key").isNotNull())
    return lines.join(orders, "sales_header_key").withColumn(
        "discount_allocated", _discount().cast("decimal(18,4)")
    )
