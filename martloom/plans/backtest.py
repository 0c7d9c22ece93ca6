"""Forecasts judged on months they have not seen, from several cut-off months, and the better model per series.

Every cut-off is one more key of the series: the history is laid out once per cut-off and the model fits all of them
in the same job.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.plans import changepoints, forecast

Model = Callable[..., DataFrame]
# The plainer model comes first: it serves series too short to be judged, and wins ties.
MODELS: tuple[tuple[str, Model], ...] = (
    (forecast.MODEL_VERSION, forecast.forecast),
    (changepoints.MODEL_VERSION, changepoints.forecast),
)


def rolling_origin(
    history: DataFrame,
    *series: str,
    model: Model = changepoints.forecast,
    origins: int = 4,
    step: int = 3,
    horizon: int = 6,
    least: int = 24,
) -> DataFrame:
    """Errors per series and cut-off over the ``horizon`` months after it.

    The last cut-off leaves ``horizon`` months to judge, earlier ones lie ``step`` months apart. A cut-off with fewer
    than ``least`` months before it is left out, as are held-out months that the forecast does not reach or that have
    no value. ``weighted_error`` is the summed error over the summed value, ``covered`` the share inside the band.
    """
    key = (*series, "cutoff")
    back = F.transform(F.sequence(F.lit(0), F.lit(origins - 1)), lambda k: F.add_months("_last", -(k * step + horizon)))
    laid = (
        history.filter(F.col("ds").isNotNull() & F.col("y").isNotNull())
        .select(*series, "ds", F.col("y").cast("double").alias("y"))
        .withColumn("_last", F.max("ds").over(Window.partitionBy(*series)))
        .withColumn("cutoff", F.explode(back))
        .filter(F.col("ds") <= F.add_months("cutoff", horizon))
        .withColumn("_past", F.count(F.when(F.col("ds") <= F.col("cutoff"), 1)).over(Window.partitionBy(*key)))
        .filter(F.col("_past") >= least)
    )
    seen = laid.filter(F.col("ds") <= F.col("cutoff")).select(*key, "ds", "y")
    held = laid.filter(F.col("ds") > F.col("cutoff")).select(*key, "ds", "y")
    told = ("forecast", "forecast_lower", "forecast_upper")
    # both sides stacked and grouped, not joined: null keys meet, and one shuffle serves
    met = (
        model(seen, *key, horizon=horizon).filter(F.col("y").isNull()).select(*key, "ds", "y", *told)
        .unionByName(held, allowMissingColumns=True)
        .groupBy(*key, "ds")
        .agg(*[F.max(c).alias(c) for c in ("y", *told)])
        .filter(F.col("y").isNotNull() & F.col("forecast").isNotNull())
    )
    error = F.col("forecast") - F.col("y")
    inside = F.col("y").between(F.col("forecast_lower"), F.col("forecast_upper"))
    return met.groupBy(*key).agg(
        F.count(F.lit(1)).alias("months"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error).alias("bias"),
        (F.sum(F.abs(error)) / F.nullif(F.sum(F.abs("y")), F.lit(0.0))).alias("weighted_error"),
        F.avg(inside.cast("int")).alias("covered"),
    )


def compared(history: DataFrame, *series: str, models: tuple[tuple[str, Model], ...] = MODELS, **origins: int) -> DataFrame:
    """``rolling_origin`` of every model, one below the other, by ``model_version``."""
    out = None
    for version, model in models:
        rows = rolling_origin(history, *series, model=model, **origins).withColumn("model_version", F.lit(version))
        out = rows if out is None else out.unionByName(rows)
    return out


def best_forecast(
    history: DataFrame,
    *series: str,
    horizon: int = forecast.HORIZON_MONTHS,
    models: tuple[tuple[str, Model], ...] = MODELS,
    **origins: int,
) -> DataFrame:
    """The forecast of the model whose mean held-out error is least, per series; ``held_out_mae`` is that error."""
    judged = compared(history, *series, models=models, **origins)
    stacked = judged.select(*series, "model_version", "mae")
    for version, model in models:
        told = model(history, *series, horizon=horizon).withColumn("model_version", F.lit(version))
        stacked = told.unionByName(stacked, allowMissingColumns=True)
    order = F.array_position(F.array(*[F.lit(version) for version, _ in models]), F.col("model_version"))
    mean = F.avg("mae").over(Window.partitionBy(*series, "model_version"))
    best = F.min(F.struct(F.coalesce("held_out_mae", F.lit(float("inf"))), "_order", "model_version"))
    return (
        stacked.withColumn("held_out_mae", mean)
        .withColumn("_order", order)
        .withColumn("_best", best.over(Window.partitionBy(*series))["model_version"])
        .filter((F.col("model_version") == F.col("_best")) & F.col("ds").isNotNull())
        .select(*series, "ds", "y", "forecast", "forecast_lower", "forecast_upper", "model_version", "held_out_mae")
    )
