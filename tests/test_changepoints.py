"""Bending trends against a restatement by stacked least squares, and errors on held-out months by hand."""

from __future__ import annotations

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.plans import backtest, changepoints, forecast
from martloom.plans.changepoints import Bends, fit_series

SEASON = [0.8, 0.9, 1.0, 1.1, 1.2, 1.1, 1.0, 0.9, 1.0, 1.1, 0.9, 1.0]


def _months(values, key="s", start=2015):
    return [(key, date(start + i // 12, i % 12 + 1, 1), None if v is None else float(v)) for i, v in enumerate(values)]


def _history(spark, *series):
    return spark.createDataFrame([row for rows in series for row in rows], "k string, ds date, y double")


def _bent(points, at, seed=1, noise=0.01):
    """Growth that stops at a month, times a cycle, with a little noise."""
    dice = np.random.default_rng(seed)
    level = [100 + 4 * min(i, at) for i in range(points)]
    return [v * SEASON[i % 12] * (1 + noise * dice.standard_normal()) for i, v in enumerate(level)]


def _stacked(months, values, how):
    """The same alternation, every step solved as one tall least-squares problem with the priors as further rows."""
    months, y = np.asarray(months, float), np.asarray(values, float)
    scale = np.abs(y).max()
    y = y / scale
    span = months.max() - months.min()
    reach = int(how.reach * span)
    marks = sorted({round(float(m)) for m in np.linspace(1, reach, min(how.candidates, reach))})

    def trend(m):
        t = (m - months.min()) / span
        return np.array([[1, x] + [max(x - c / span, 0) for c in marks] for x in t])

    def cycle(m):
        rows = []
        for x in m:
            a = 2 * np.pi * ((x - 1) % 12) / 12
            rows.append([f(k * a) for k in range(1, min(6, len(y) // 6) + 1) for f in (np.cos, np.sin) if not (k == 6 and f is np.sin)])
        return np.array(rows)

    def ridge(x, target, weights):
        tall = np.vstack([x, np.diag(np.sqrt(weights))])
        beta = np.linalg.lstsq(tall, np.concatenate([target, np.zeros(len(weights))]), rcond=None)[0]
        u, _, _ = np.linalg.svd(tall, full_matrices=False)
        return beta, float((u[: len(x)] ** 2).sum())

    a, s = trend(months), cycle(months)
    theta, delta, noise = np.zeros(s.shape[1]), np.zeros(len(marks)), y.var()
    for _ in range(how.rounds):
        weights = [noise / how.level_scale**2] * 2 + list(noise / (how.slope_scale * np.sqrt(delta**2 + 1e-6)))
        b, free = ridge(a * (1 + s @ theta)[:, None], y, np.array(weights))
        delta, g = b[2:], a @ b
        theta, turns = ridge(s * g[:, None], y - g, np.full(s.shape[1], noise / how.season_scale**2))
        rest = y - g * (1 + s @ theta)
        noise = max(rest @ rest / max(len(y) - free - turns, 1), 1e-8)
    return lambda m: (trend(np.asarray(m, float)) @ b) * (1 + cycle(np.asarray(m, float)) @ theta) * scale


@pytest.mark.parametrize(("points", "at"), [(60, 36), (84, 20), (30, 12), (60, 99)])
def test_fit_equals_stacked_least_squares(points, at):
    months, values = np.arange(24181, 24181 + points), np.array(_bent(points, at))
    every, fitted, *_ = fit_series(months, values, 12, 0, Bends())
    assert list(every) == list(range(24181, 24181 + points + 12))
    assert fitted == pytest.approx(_stacked(months, values, Bends())(every), rel=1e-6)


def test_query_equals_the_restatement(spark):
    values = _bent(60, 36)
    out = changepoints.forecast(_history(spark, _months(values)), "k", horizon=6).orderBy("ds").collect()
    model = _stacked(np.arange(24181, 24241), values, Bends())
    assert [r.forecast for r in out] == pytest.approx(list(model(np.arange(24181, 24247))), rel=1e-6)
    assert [r.ds for r in out[-6:]] == [date(2020, m, 1) for m in range(1, 7)]
    assert [r.y for r in out] == [pytest.approx(v) for v in values] + [None] * 6
    assert all(r.forecast_lower <= r.forecast <= r.forecast_upper for r in out)


def test_a_bend_is_found_where_it_is(spark):
    changes = changepoints.trend_changes(_history(spark, _months(_bent(72, 36))), "k").collect()
    main = max(changes, key=lambda r: abs(r.slope_change))
    assert abs((main.ds.year - 2015) * 12 + main.ds.month - 1 - 36) <= 3
    assert sum(r.slope_change for r in changes) == pytest.approx(-4, abs=1)
    assert changepoints.trend_changes(_history(spark, _months([100 + 4 * i for i in range(72)])), "k").count() == 0


def test_beats_the_plain_model_on_held_out_months_of_bent_series(spark):
    history = _history(spark, *[_months(_bent(72, at, seed=at, noise=0.02), key=f"s{at}") for at in (24, 30, 36, 42)])
    rows = backtest.compared(history, "k", origins=3, step=3, horizon=6).collect()
    assert len(rows) == 4 * 3 * 2
    error = {v: {} for v, _ in backtest.MODELS}
    for r in rows:
        error[r.model_version].setdefault(r.k, []).append(r.mae)
    for k in ("s24", "s30", "s36", "s42"):
        plain, bends = (np.mean(error[v][k]) for v, _ in backtest.MODELS)
        assert bends < plain / 2


def test_a_line_goes_on_and_a_cycle_repeats(spark):
    history = _history(spark, _months(range(100, 160), "line"), _months([100 * SEASON[i % 12] for i in range(60)], "cycle"))
    out = changepoints.forecast(history, "k", horizon=12).filter("y IS NULL").orderBy("ds").collect()
    assert [r.forecast for r in out if r.k == "line"] == pytest.approx(range(160, 172), rel=0.01)
    assert [r.forecast for r in out if r.k == "cycle"] == pytest.approx([100 * s for s in SEASON], rel=0.01)


@pytest.mark.parametrize("values", [[42], [42, 42], [0, 0, 0], [-5, -5, -5, -5]])
def test_short_and_constant_series_stay_flat(spark, values):
    out = changepoints.forecast(_history(spark, _months(values)), "k", horizon=3).collect()
    assert len(out) == len(values) + 3
    assert [r.forecast for r in out] == pytest.approx([values[0]] * len(out), abs=1e-3)


def test_nulls_empty_tables_and_clashing_names(spark):
    rows = [*_months(_bent(48, 20), None), *_months(_bent(48, 20), "s"), *_months([None, None], "gone"), ("s", None, 7.0)]
    wide = _history(spark, rows).withColumn("fit", F.lit(1)).withColumn("month", F.lit("x")).withColumn("_n", F.lit(0))
    out = changepoints.forecast(wide, "k", horizon=2)
    assert out.columns == ["k", "ds", "y", "forecast", "forecast_lower", "forecast_upper", "model_version"]
    got = {}
    for r in out.orderBy("ds").collect():
        got.setdefault(r.k, []).append(r.forecast)
    assert set(got) == {None, "s"} and got[None] == pytest.approx(got["s"]) and len(got["s"]) == 50
    none = spark.createDataFrame([], "k string, ds date, y double")
    assert changepoints.forecast(none, "k").count() == changepoints.forecast(none).count() == 0
    assert changepoints.trend_changes(none, "k").count() == backtest.compared(none, "k").count() == 0
    assert backtest.best_forecast(none, "k").count() == 0


def test_gaps_are_months_without_rows(spark):
    rows = [r for i, r in enumerate(_months(range(100, 160))) if i not in (7, 30, 31)]
    out = changepoints.forecast(_history(spark, rows), "k", horizon=2).orderBy("ds").collect()
    assert len(out) == 59 and [r.forecast for r in out[-2:]] == pytest.approx([160, 161], rel=0.01)


def test_band_widens_only_where_trends_have_bent(spark):
    def widths(values):
        out = changepoints.forecast(_history(spark, _months(values)), "k", horizon=24).filter("y IS NULL").orderBy("ds")
        return [r.forecast_upper - r.forecast_lower for r in out.collect()]

    bent = widths(_bent(72, 36, noise=0.02))
    assert bent[-1] > 1.5 * bent[0]
    assert widths(_bent(72, 36, noise=0.02)) == bent  # drawn alike at every run


def test_rolling_origin_by_hand(spark):
    values = [*range(100, 130), 140, 125]

    def last(known, *keys, horizon):
        """Tomorrow as today, give or take five."""
        top = known.groupBy(*keys).agg(F.max_by("y", "ds").alias("forecast"), F.max("ds").alias("_last"))
        ahead = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
        return top.withColumn("_k", ahead).select(
            *keys, F.add_months("_last", F.col("_k")).alias("ds"), F.lit(None).cast("double").alias("y"), "forecast",
            (F.col("forecast") - 5).alias("forecast_lower"), (F.col("forecast") + 5).alias("forecast_upper"),
        )

    rows = backtest.rolling_origin(_history(spark, _months(values)), "k", model=last, origins=3, step=4, horizon=2, least=24)
    got = {r.cutoff: r for r in rows.collect()}
    assert set(got) == {date(2017, 6, 1), date(2017, 2, 1)}  # the third has 22 months before it
    june = got[date(2017, 6, 1)]  # knows 129; the months held out are 140 and 125
    assert (june.months, june.mae, june.bias, june.covered) == (2, 7.5, -3.5, 0.5)
    assert june.weighted_error == pytest.approx(15 / 265)
    assert got[date(2017, 2, 1)].mae == 1.5


def test_best_model_serves_each_series(spark):
    history = _history(
        spark, _months(_bent(72, 30, noise=0.02), "bent"), _months([100, 101, 102], "short"), _months(_bent(72, 30, noise=0.02), None)
    )
    best = backtest.best_forecast(history, "k", horizon=3)
    got = {r.k: (r.model_version, r.n, r.e) for r in best.groupBy("k", "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.max("held_out_mae").alias("e")).collect()}
    assert got["short"] == (forecast.MODEL_VERSION, 6, None)
    assert got["bent"][:2] == got[None][:2] == (changepoints.MODEL_VERSION, 75)
    assert got["bent"][2] > 0


def test_plan_fits_all_series_in_one_python_step_after_one_exchange(spark):
    # a group's months meet once, each fit runs once although five of its fields are read
    plan = changepoints.forecast(_history(spark, _months(_bent(36, 20))), "k")._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("ArrowEvalPython") == 1 and initial.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
