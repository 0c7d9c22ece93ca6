"""Content compared by digests names exactly the keys that differ, and reads again only where ranges do."""

from __future__ import annotations

from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from martloom.operators import digests
from martloom.operators.digests import content_differences

SCHEMA = "k long, g string, amount decimal(18,4), x double"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("key", [["k"], ["g"], ["k", "g"]])
def test_every_difference_is_named(spark, key):
    rnd = Random(len(key))
    rows = [(k - 500 if k % 97 else None, f"g{k}", Decimal(k) / 100, float(k)) for k in range(3000)]
    changed = {5: "amount", 700: "x", 2999: "amount"}
    other = [(k, g, a + Decimal("0.01") if changed.get(i) == "amount" else a, -x if changed.get(i) == "x" else x) for i, (k, g, a, x) in enumerate(rows)]
    del other[1234]
    other += [(999_999, "new", Decimal(1), 1.0), other[40]]
    rnd.shuffle(other)
    source, target = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(other, SCHEMA).repartition(5)
    got = content_differences(source, target, key)
    at = {"k": 0, "g": 1}
    want = [
        *(((*[rows[i][at[c]] for c in key], "changed", 1, 1)) for i in changed),
        (*[rows[1234][at[c]] for c in key], "missing", 1, 0),
        (*[(999_999, "new")[at[c]] for c in key], "extra", 0, 1),
        (*[rows[40][at[c]] for c in key], "extra", 0, 1),
    ]
    assert rows_of(got) == sorted(want, key=str)


def test_equal_tables_in_another_order_and_type(spark):
    rows = [(k, str(k), Decimal(k), 0.0 if k % 2 else -0.0) for k in range(500)] * 2
    source = spark.createDataFrame(rows, SCHEMA)
    target = source.orderBy(F.desc("k")).select("x", F.col("amount").cast("decimal(30,6)"), "g", F.col("k").cast("decimal(20,0)"))
    assert content_differences(source, target, ["k"]).collect() == []


@pytest.mark.parametrize("left,right", [(0, 0), (3, 0), (0, 3)])
def test_empty_sides(spark, left, right):
    rows = [(k, "g", Decimal(k), 1.0) for k in range(3)]
    got = content_differences(spark.createDataFrame(rows[:left], SCHEMA), spark.createDataFrame(rows[:right], SCHEMA), ["k"])
    assert [(r.k, r.kind) for r in got.orderBy("k").collect()] == [(k, "missing" if left else "extra") for k in range(max(left, right))]


def test_far_apart_and_negative_keys(spark):
    keys = [-(1 << 62), -5, 0, 7, (1 << 62) + 3]
    source = spark.createDataFrame([(k, "g", Decimal(1), 1.0) for k in keys], SCHEMA)
    target = source.withColumn("amount", F.when(F.col("k") == (1 << 62) + 3, Decimal(2)).otherwise(F.col("amount")).cast("decimal(18,4)"))
    assert [(r.k, r.kind) for r in content_differences(source, target, ["k"]).collect()] == [((1 << 62) + 3, "changed")]


def test_only_differing_ranges_are_read_again(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(200_000).selectExpr("id AS k", "CAST(id AS DECIMAL(18,4)) AS amount").repartitionByRange(20, "k").write.parquet(path)
    source = spark.read.parquet(path)
    target = source.withColumn("amount", (F.col("amount") + F.when(F.col("k") == 123_456, F.lit(Decimal("0.01"))).otherwise(F.lit(Decimal("0.00")))).cast("decimal(18,4)"))
    found = content_differences(source, target, ["k"])
    assert [tuple(r) for r in found.collect()] == [(123_456, "changed", 1, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and all("GreaterThanOrEqual(k,123456)" in p and "LessThanOrEqual(k,123456)" in p for p in pushed)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_columns_that_only_one_side_has_are_an_error(spark):
    source = spark.createDataFrame([(1, "g", Decimal(1), 1.0)], SCHEMA)
    with pytest.raises(ValueError, match="amount"):
        content_differences(source, source.drop("amount"), ["k"])


def test_more_ranges_than_conditions(spark, monkeypatch):
    monkeypatch.setattr(digests, "CONDITIONS", 2)
    source = spark.range(1000).selectExpr("id AS k", "id AS v")
    target = source.withColumn("v", F.when(F.col("k") % 100 == 3, -1).otherwise(F.col("v")).cast("long"))
    got = content_differences(source, target, ["k"])
    assert sorted(r.k for r in got.collect()) == list(range(3, 1000, 100))
