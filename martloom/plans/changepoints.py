"""Forecast whose trend may bend: a piecewise line times a yearly cycle, fitted per series.

Level and cycle are fitted in turn, each from the normal equations of its own terms. A candidate month may change
the slope; the changes carry a Laplace prior, so most shrink to nothing and a real bend keeps its size. The band of
future months comes from simulated further changes, as frequent and as large as those found.

A series arrives at its fit as two arrays of months and values, no longer than the calendar, so any number of
series is spread over the cluster and no series has more rows than months.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.plans.forecast import BAND_WIDTH, HORIZON_MONTHS

MODEL_VERSION = "bend-season-1"


@dataclass(frozen=True)
class Bends:
    """How far a trend may bend and a cycle swing; scales are relative to the largest value of a series."""

    candidates: int = 25
    reach: float = 0.8
    slope_scale: float = 0.05
    season_scale: float = 1.0
    level_scale: float = 5.0
    rounds: int = 40
    draws: int = 1000
    seed: int = 7


def _cycle(months: np.ndarray, harmonics: int) -> np.ndarray:
    """Yearly sines and cosines; the sixth sine is zero in every month and left out."""
    angle = 2 * np.pi * ((months - 1) % 12) / 12
    terms = [wave(k * angle) for k in range(1, harmonics + 1) for wave in (np.cos, np.sin) if k < 6 or wave is np.cos]
    return np.column_stack(terms) if terms else np.zeros((len(months), 0))


def _trend(at: np.ndarray, bends: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(at)), at, np.maximum(at[:, None] - bends[None, :], 0.0)])


def _solved(terms: np.ndarray, target: np.ndarray, penalty: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients of the penalised normal equations, and how many free parameters they amount to."""
    gram = terms.T @ terms
    ridge = gram + np.diag(penalty)
    return np.linalg.solve(ridge, terms.T @ target), float(np.trace(np.linalg.solve(ridge, gram)))


def fit_series(months: np.ndarray, values: np.ndarray, horizon: int, seed: int, how: Bends) -> tuple:
    """Months, fitted and future values, both ends of the band, candidate months and their changes of monthly slope."""
    first, last = int(months.min()), int(months.max())
    span = max(last - first, 1)
    scale = float(np.abs(values).max()) or 1.0
    y, at = values / scale, (months - first) / span
    reach = int(how.reach * span)
    marks = np.unique(np.linspace(1, reach, min(how.candidates, reach)).round()) if reach else np.zeros(0)
    shape, wave = _trend(at, marks / span), _cycle(months, min(6, len(y) // 6))
    change, swing, noise = np.zeros(len(marks)), np.zeros(wave.shape[1]), max(float(y.var()), 1e-8)
    for _ in range(how.rounds):
        season = 1 + wave @ swing
        # a Laplace prior as a ridge that is weak where the last change was large
        bend_penalty = noise / (how.slope_scale * np.sqrt(change**2 + 1e-6))
        penalty = np.concatenate([np.full(2, noise / how.level_scale**2), bend_penalty])
        line, free = _solved(shape * season[:, None], y, penalty)
        change, level = line[2:], shape @ line
        swing, turns = _solved(wave * level[:, None], y - level, np.full(wave.shape[1], noise / how.season_scale**2))
        error = y - level * (1 + wave @ swing)
        noise = max(float(error @ error) / max(len(y) - free - turns, 1.0), 1e-8)

    ahead = np.arange(last + 1, last + horizon + 1)
    every = np.concatenate([months, ahead])
    season = 1 + _cycle(every, min(6, len(y) // 6)) @ swing
    fitted = (_trend((every - first) / span, marks / span) @ line) * season
    spread = float(np.sqrt(noise))
    low, high = fitted - BAND_WIDTH * spread, fitted + BAND_WIDTH * spread
    if horizon:
        dice = np.random.default_rng([how.seed, seed])
        happens = dice.random((how.draws, horizon)) < len(marks) / span
        size = np.abs(change).mean() if len(change) else 0.0
        slopes = np.cumsum(happens * dice.laplace(0.0, size + 1e-12, (how.draws, horizon)), axis=1)
        drift = np.cumsum(slopes / span, axis=1) * season[len(months) :]
        paths = drift + dice.normal(0.0, spread, (how.draws, horizon))
        below, above = np.quantile(paths, [0.1, 0.9], axis=0)
        low[len(months) :] = fitted[len(months) :] + np.minimum(below, 0.0)
        high[len(months) :] = fitted[len(months) :] + np.maximum(above, 0.0)
    return every, fitted * scale, low * scale, high * scale, first + marks.astype(int), change * scale / span


def _fitter(horizon: int, how: Bends):
    @F.pandas_udf(
        "month array<int>, forecast array<double>, forecast_lower array<double>, forecast_upper array<double>,"
        " bend array<int>, slope_change array<double>"
    )
    def fit(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names = ["month", "forecast", "forecast_lower", "forecast_upper", "bend", "slope_change"]
        for months, values, seeds in batches:
            rows = [
                fit_series(np.asarray(m), np.asarray(v, dtype=float), horizon, int(s), how)
                for m, v, s in zip(months, values, seeds, strict=True)
            ]
            yield pd.DataFrame(rows, columns=names)

    return fit


def _first_of(month: Column) -> Column:
    return F.make_date(F.floor((month - 1) / 12).cast("int"), (month - 1) % 12 + 1, F.lit(1))


def _fits(history: DataFrame, series: tuple[str, ...], horizon: int, how: Bends) -> DataFrame:
    """One row per series: its months and values in order, and ``fit``."""
    point = F.struct((F.year("ds") * 12 + F.month("ds")).alias("n"), F.col("y").cast("double").alias("y"))
    seed = F.crc32(F.to_json(F.struct(*series)).cast("binary")) if series else F.lit(0).cast("long")
    return (
        history.filter(F.col("ds").isNotNull() & F.col("y").isNotNull() & ~F.isnan(F.col("y").cast("double")))
        .groupBy(*series)
        .agg(F.array_sort(F.collect_list(point)).alias("_points"))
        .filter(F.size("_points") > 0)
        .select(*series, F.col("_points.n").alias("_n"), F.col("_points.y").alias("_y"), seed.alias("_seed"))
        .select(*series, F.col("_y").alias("y"), _fitter(horizon, how)("_n", "_y", "_seed").alias("fit"))
    )


def forecast(
    history: DataFrame,
    *series: str,
    horizon: int = HORIZON_MONTHS,
    model_version: str = MODEL_VERSION,
    how: Bends = Bends(),
) -> DataFrame:
    """Fitted history plus ``horizon`` further months per series, in the columns of the plain forecast.

    Rows without month or value are left out; null series keys are a series; an empty history gives no rows. A
    series of one month stays flat, and one of few months has fewer yearly terms (one pair per six months).
    """
    ends = ("month", "forecast", "forecast_lower", "forecast_upper")
    rows = _fits(history, series, horizon, how).select(*series, "y", *[F.col(f"fit.{e}").alias(e) for e in ends])
    return rows.select(*series, F.inline(F.arrays_zip("month", "y", *ends[1:]))).select(
        *series, _first_of(F.col("month")).alias("ds"), "y", *ends[1:], F.lit(model_version).alias("model_version")
    )


def trend_changes(history: DataFrame, *series: str, least: float = 0.01, how: Bends = Bends()) -> DataFrame:
    """Months at which a trend bends, and by how much a month; shares of a series' largest value below ``least`` a year are left out."""
    fits = _fits(history, series, 0, how).select(
        *series, F.array_max(F.transform("y", F.abs)).alias("_top"),
        F.col("fit.bend").alias("_month"), F.col("fit.slope_change").alias("slope_change"),
    )
    return (
        fits.select(*series, "_top", F.inline(F.arrays_zip("_month", "slope_change")))
        .filter(F.abs("slope_change") * 12 >= F.lit(least) * F.col("_top"))
        .select(*series, _first_of(F.col("_month")).alias("ds"), "slope_change")
    )
