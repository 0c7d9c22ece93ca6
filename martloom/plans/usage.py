"""Usage cost at the price valid at the time, tag attribution, and query activity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.intervals import aligned, interval_join

WINDOW_DAYS = 30


def since(column: Column, as_of: Column, days: int = WINDOW_DAYS) -> Column:
    """True for dates within the last ``days`` before ``as_of`` (pass current_date() in production)."""
    return column >= F.date_sub(as_of, days)


def priced_usage(usage: DataFrame, prices: DataFrame, bucket_days: int | None = None) -> DataFrame:
    """Usage matched to the price period that holds all of it; straddling usage matches none."""
    return interval_join(
        usage,
        prices,
        key="sku_name",
        left=("usage_start_time", "usage_end_time"),
        right=("price_start_time", "price_end_time"),
        bucket_days=bucket_days,
    )


def cost_by_product(
    usage: DataFrame, prices: DataFrame, as_of: Column, bucket_days: int | None = None
) -> DataFrame:
    recent = usage.filter(since(F.col("usage_date"), as_of))
    amount = F.col("usage_quantity") * F.col("pricing.default")
    return (
        priced_usage(recent, prices, bucket_days)
        .groupBy("billing_origin_product")
        .agg(F.round(F.sum(amount), 2).alias("custo_usd"))
    )


def aligned_cost_by_product(
    usage: DataFrame, prices: DataFrame, as_of: Column, prorate: bool = False, bucket_days: int = 7, salts: int = 1
) -> DataFrame:
    """``cost_by_product`` by one sort of usage and prices; ``prorate`` splits usage at price changes."""
    recent = usage.filter(since(F.col("usage_date"), as_of))
    priced = aligned(
        recent, prices, "sku_name", ("usage_start_time", "usage_end_time"), ("price_start_time", "price_end_time"),
        "usage_quantity" if prorate else None, bucket_days, salts,
    )
    return priced.groupBy("billing_origin_product").agg(
        F.round(F.sum(F.col("usage_quantity") * F.col("pricing.default")), 2).alias("custo_usd")
    )


def usage_by_tag(usage: DataFrame, tag: str, as_of: Column) -> DataFrame:
    return (
        usage.filter(since(F.col("usage_date"), as_of))
        .groupBy(F.col("custom_tags").getItem(tag).alias("dominio"))
        .agg(F.round(F.sum("usage_quantity"), 4).alias("qtd"))
    )


def queries_per_day(history: DataFrame, as_of: Column) -> DataFrame:
    return (
        history.filter(since(F.col("start_time").cast("date"), as_of))
        .groupBy(F.col("start_time").cast("date").alias("dia"))
        .agg(F.count(F.lit(1)).alias("queries"))
    )


def latency_by_user(history: DataFrame, as_of: Column) -> DataFrame:
    return (
        history.filter(since(F.col("start_time").cast("date"), as_of))
        .groupBy("executed_by")
        .agg(
            F.count(F.lit(1)).alias("queries"),
            F.round(F.sum("total_duration_ms").cast("double") / F.count("total_duration_ms") / 1000, 1)
            .alias("media_seg"),
        )
    )
