"""Monthly history and a closed-form seasonal forecast per series.

Linear trend times a month-of-year index, fitted for every series at once with window
aggregates, so the number of series scales with the cluster. The band is the 80 % interval of
the in-sample residuals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import dates

HORIZON_MONTHS = 14
MODEL_VERSION = "trend-season-1"
# Fixed value: two-sided 80 % normal quantile.
BAND_WIDTH = 1.2816


def monthly_history(sales: DataFrame) -> DataFrame:
    """Gross sales per month, as ``ds`` and ``y``."""
    return (
        sales.filter(F.col("order_date").isNotNull())
        .groupBy(dates.month_start(F.col("order_date")).alias("ds"))
        .agg(F.sum("gross_sales").cast("double").alias("y"))
    )


def product_history(sales: DataFrame, product: DataFrame, *series: str) -> DataFrame:
    """Gross sales per month and product attribute; products are joined once summed per month."""
    per_product = (
        sales.filter(F.col("order_date").isNotNull())
        .groupBy("product_key", dates.month_start(F.col("order_date")).alias("ds"))
        .agg(F.sum("gross_sales").alias("_gross"))
    )
    return (
        per_product.join(product.select("product_key", *series), "product_key")
        .groupBy(*series, "ds")
        .agg(F.sum("_gross").cast("double").alias("y"))
    )


def _month_number(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def fitted(history: DataFrame, *series: str) -> DataFrame:
    """History with trend, seasonal index and residual spread of its series."""
    group = Window.partitionBy(*series)
    same_month = Window.partitionBy(*series, "moy")
    y, t = F.col("y"), F.col("t")
    return (
        history.withColumn("_n", _month_number(F.col("ds")))
        .withColumn("_first", F.min("_n").over(group))
        .withColumn("t", (F.col("_n") - F.col("_first")).cast("double"))
        .withColumn("moy", F.month("ds"))
        .withColumn("points", F.count(F.lit(1)).over(group))
        .withColumn("slope", F.coalesce(F.regr_slope(y, t).over(group), F.lit(0.0)))
        .withColumn("intercept", F.coalesce(F.regr_intercept(y, t).over(group), F.avg(y).over(group)))
        .withColumn("trend", F.col("intercept") + F.col("slope") * t)
        .withColumn("_rel", y / F.nullif(F.col("trend"), F.lit(0.0)))
        .withColumn("_raw", F.avg("_rel").over(same_month))
        .withColumn("_share", 1.0 / F.count(F.lit(1)).over(same_month))
        .withColumn(
            "_mean",
            F.sum(F.col("_raw") * F.col("_share")).over(group) / F.sum("_share").over(group),
        )
        .withColumn(
            "season",
            F.coalesce(F.col("_raw") / F.nullif(F.col("_mean"), F.lit(0.0)), F.lit(1.0)),
        )
        .withColumn("_error", y - F.col("trend") * F.col("season"))
        .withColumn(
            "spread",
            F.sqrt(F.sum(F.col("_error") * F.col("_error")).over(group) / F.greatest(F.col("points") - 2, F.lit(1))),
        )
    )


def forecast(
    history: DataFrame,
    *series: str,
    horizon: int = HORIZON_MONTHS,
    model_version: str = MODEL_VERSION,
) -> DataFrame:
    """Fitted history plus ``horizon`` further months for every series.

    A series collapses to its twelve-entry seasonal index and its list of months (bounded by
    the length of the calendar), then unfolds into history and future in the same pass.
    """
    model = fitted(history, *series).groupBy(*series).agg(
        F.max("slope").alias("slope"),
        F.max("intercept").alias("intercept"),
        F.max("spread").alias("spread"),
        F.max("_first").alias("first"),
        F.max("ds").alias("last_ds"),
        F.map_from_entries(F.collect_set(F.struct("moy", "season"))).alias("seasons"),
        F.collect_list(F.struct("ds", "y")).alias("known"),
    )
    future = F.transform(
        F.sequence(F.lit(1), F.lit(horizon)),
        lambda k: F.struct(
            F.add_months(F.col("last_ds"), k).alias("ds"), F.lit(None).cast("double").alias("y")
        ),
    )
    at = F.col("ds")
    t = (_month_number(at) - F.col("first")).cast("double")
    season = F.coalesce(F.col("seasons")[F.month(at)], F.lit(1.0))
    band = F.col("spread") * BAND_WIDTH
    return (
        model.select("*", F.inline(F.concat("known", future)))
        .withColumn("forecast", (F.col("intercept") + F.col("slope") * t) * season)
        .select(
            *series,
            "ds",
            "y",
            "forecast",
            (F.col("forecast") - band).alias("forecast_lower"),
            (F.col("forecast") + band).alias("forecast_upper"),
            F.lit(model_version).alias("model_version"),
        )
    )


def in_sample_mae(predicted: DataFrame, *series: str) -> DataFrame:
    return (
        predicted.filter(F.col("y").isNotNull())
        .groupBy(*series)
        .agg(F.avg(F.abs(F.col("forecast") - F.col("y"))).alias("mae"))
    )


def served_forecast(predicted: DataFrame) -> DataFrame:
    return predicted.select("ds", "forecast", "forecast_lower", "forecast_upper").orderBy("ds")
