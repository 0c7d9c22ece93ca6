"""Periods aligned to facts by one sort: the rows of the containment join, and shares of what reaches over a change."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from martloom.operators.intervals import aligned, interval_join

T0 = datetime(2024, 1, 1)
FACTS = "sku string, a timestamp_ntz, b timestamp_ntz, n int, quantity decimal(18,2)"
PERIODS = "sku string, p_from timestamp_ntz, p_to timestamp_ntz, price int"
HOW = ("sku", ("a", "b"), ("p_from", "p_to"))


def price_list(rnd, sku, n, first=0):
    """Periods that follow each other, now and then after a gap; the last one is open for every other key."""
    out, at = [], T0 + timedelta(minutes=first)
    for i in range(n):
        end = at + timedelta(minutes=rnd.randrange(1, 3000))
        out.append((sku, at, None if i == n - 1 and len(sku) % 2 else end, len(out)))
        at = end + timedelta(minutes=rnd.choice([0, 0, 0, 50]))
    return out


def cases(seed, n=400):
    rnd = Random(seed)
    periods = [p for sku, k in (("hot", 30), ("s1", 5), ("s22", 1), ("s3", 12)) for p in price_list(rnd, sku, k, rnd.randrange(4000))]
    facts = []
    for i in range(n):
        sku = "hot" if i % 3 == 0 else rnd.choice(["s1", "s22", "s3", "unpriced"])
        start = T0 + timedelta(minutes=rnd.randrange(60 * 24 * 40))
        facts.append((sku, start, start + timedelta(minutes=rnd.choice([0, 1, 30, 600, 9000])), i, Decimal(rnd.randrange(1, 9999)) / 100))
    facts += facts[:5] + [(None, T0, T0, -1, Decimal(1)), ("hot", None, T0, -2, Decimal(1)), ("hot", T0, None, -3, None)]
    return facts, periods


@pytest.mark.parametrize("seed,bucket_days,salts", [(1, 7, 1), (2, 1, 3), (3, 400, 1), (4, 3, 2)])
def test_aligned_equals_the_containment_join(spark, seed, bucket_days, salts):
    facts, periods = cases(seed)
    changes = {(p[0], p[1]) for p in periods}
    facts = [f for f in facts if not (f[1] == f[2] and (f[0], f[1]) in changes)]
    left, right = spark.createDataFrame(facts, FACTS), spark.createDataFrame(periods, PERIODS)
    got = aligned(left, right, *HOW, bucket_days=bucket_days, salts=salts)
    want = interval_join(left, right, *HOW)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) != []


@pytest.mark.parametrize("seed,bucket_days,salts", [(5, 7, 1), (6, 1, 3)])
def test_shares_match_brute_force(spark, seed, bucket_days, salts):
    facts, periods = cases(seed, 200)
    far = datetime(2100, 1, 1)
    want = []
    for sku, a, b, n, q in facts:
        if sku is None or a is None or b is None:
            continue
        for s, f, t, price in periods:
            if s != sku:
                continue
            if a == b and f <= a and b <= (t or far) and not any(x[0] == s and x[1] == a and x[1] > f for x in periods):
                want.append((n, price, a, b, float(q)))
            low, high = max(a, f), min(b, t or far)
            if low < high:
                want.append((n, price, low, high, float(q) * ((high - low) / (b - a))))
    got = aligned(spark.createDataFrame(facts, FACTS), spark.createDataFrame(periods, PERIODS), *HOW, prorate="quantity", bucket_days=bucket_days, salts=salts)
    rows = sorted((r.n, r.price, r.a, r.b, float(r.quantity)) for r in got.collect())
    assert len(rows) == len(want)
    for r, w in zip(rows, sorted(want)):
        assert r[:4] == w[:4] and r[4] == pytest.approx(w[4], abs=1e-6)


def test_a_hot_key_of_ten_thousand_periods_is_shared_by_tasks(spark):
    periods = spark.range(10_000).selectExpr(
        "'hot' AS sku", "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, 15 * id) AS p_from",
        "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, 15 * (id + 1)) AS p_to", "CAST(id AS INT) AS price",
    )
    facts = spark.range(40_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id) END AS sku",
        "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, id * 3, 30) AS a",
        "TIMESTAMP_NTZ '2024-01-01' + make_dt_interval(0, 0, id * 3 + 1) AS b", "CAST(id AS INT) AS n", "CAST(1 AS DECIMAL(18,2)) AS quantity",
    )
    joined = aligned(facts, periods, *HOW, bucket_days=5, salts=4)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_key" in plan and "_salt" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    rows = joined.select((F.col("price") == F.floor(F.col("n") * 3 / 15)).alias("right")).groupBy("right").count().collect()
    assert [(r["right"], r["count"]) for r in rows] == [(True, 13_334)]


def test_empty_sides(spark):
    facts, periods = cases(1, 20)
    some, none = spark.createDataFrame(facts, FACTS), spark.createDataFrame([], FACTS)
    prices, no_prices = spark.createDataFrame(periods, PERIODS), spark.createDataFrame([], PERIODS)
    for left, right in ((none, prices), (some, no_prices), (none, no_prices)):
        for prorate in (None, "quantity"):
            assert aligned(left, right, *HOW, prorate=prorate).collect() == []


def test_periods_are_laid_out_between_oldest_and_newest_fact_only(spark):
    facts = spark.createDataFrame([("a", T0, T0 + timedelta(hours=1), 1, Decimal(1))], FACTS)
    periods = spark.createDataFrame([("a", datetime(1900, 1, 1), None, 1), ("a", datetime(1900, 1, 1), datetime(1900, 1, 2), 2)], PERIODS)
    joined = interval_join(facts, periods, *HOW, 1)
    assert [r.price for r in joined.collect()] == [1]
    assert max(int(x) for x in _generated(joined)) <= 1


def _generated(df):
    """Rows that explodes gave, from the metrics of the plan that ran."""
    node, found = [df._jdf.queryExecution().executedPlan()], []
    while node:
        plan = node.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node.append(plan.executedPlan())
            continue
        if plan.getClass().getSimpleName() in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            node.append(plan.plan())
            continue
        if plan.getClass().getSimpleName() == "GenerateExec":
            found.append(plan.metrics().apply("numOutputRows").value())
        children = plan.children()
        node += [children.apply(i) for i in range(children.size())]
    return found or [0]
