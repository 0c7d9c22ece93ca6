from __future__ import annotations

from decimal import Decimal

import pytest

from martloom.operators.conform import ConformSpec, Field, conform, keep_latest, parse_failures, to_silver
from martloom.operators.quality import Expectation, enforce, flag, observed, quality_report
from martloom.plans.silver import SPECS


def test_latest_version_wins_and_rules_run_after(spark):
    bronze = spark.createDataFrame(
        [
            (1, "7", " old ", "10,00"),
            (5, "7", " New ", "1.000,50"),
            (9, "8", "negative", "-1"),
            (3, None, "no key", "1"),
            (4, None, "no key either", "1"),
        ],
        "id long, customerkey string, customer string, annualrevenue string",
    )
    spec = ConformSpec(
        "customer",
        (Field("customer_key", "customerkey", "key"), Field("customer_name", "customer", "text"), Field("annual_revenue", "annualrevenue", "revenue")),
        ("customerkey",),
        SPECS["customer"].rules,
    )
    assert conform(bronze, spec).count() == 3  # keys 7, 8 and one for the missing key
    rows = to_silver(bronze, spec).collect()
    assert [(r.customer_key, r.customer_name, r.annual_revenue, r._source_id) for r in rows] == [
        (7, "New", Decimal("1000.50"), 5)
    ]


def test_older_good_row_does_not_replace_newer_bad_one(spark):
    """Rules see the deduplicated rows, so a key whose newest version is bad disappears."""
    bronze = spark.createDataFrame([(1, "1", "5"), (2, "1", "-5")], "id long, k string, v string")
    spec = ConformSpec(
        "t", (Field("k", "k", "key"), Field("v", "v", "money")), ("k",), (Expectation("pos", "v >= 0"),)
    )
    assert to_silver(bronze, spec).count() == 0


def test_composite_key(spark):
    spec = SPECS["product_cost_history"]
    bronze = spark.createDataFrame(
        [(1, 5, "BR", 2024, 1, "1,5"), (2, 5, "BR", 2024, 1, "2,5"), (3, 5, "US", 2024, 1, "3,5"), (4, 5, "BR", 2024, 2, "x")],
        "id long, productkey long, countrycode string, Year int, monthno int, unitcost string",
    )
    got = {(r.country_code, r.month_no): r.unit_cost for r in to_silver(bronze, spec).collect()}
    assert got == {("BR", 1): Decimal("2.5000"), ("US", 1): Decimal("3.5000"), ("BR", 2): None}


def test_keep_latest_with_a_dominant_key(spark):
    """A third of all rows share one key; the rank limit runs before the shuffle."""
    df = spark.range(30_000).selectExpr("CASE WHEN id < 10000 THEN -1 ELSE id END AS k", "id")
    latest = keep_latest(df, ("k",), "id")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.count() == 20_001
    assert latest.filter("k = -1").first().id == 9_999


def test_parse_failures_counts_only_present_text(spark):
    spec = ConformSpec("t", (Field("amount", "a", "money"), Field("day", "d", "date")), ("a",))
    bronze = spark.createDataFrame([("$5", "2024-01-01"), ("", None), ("1,5", "01/02/2024"), (None, "x")], "a string, d string")
    assert {(r.column_name, r.unreadable) for r in parse_failures(bronze, spec).collect()} == {("amount", 1), ("day", 2)}


RULES = (Expectation("positive", "v >= 0"), Expectation("small", "v < 10", "track"))


def test_null_counts_as_violation(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,), (50,)], "v int")
    assert sorted(r.v for r in enforce(df, RULES).collect()) == [1, 50]
    report = {(r.rule_name, r.passed, r.failed) for r in quality_report(df, "t", RULES).collect()}
    assert report == {("positive", 2, 2), ("small", 2, 2)}
    flags = {(r.v, r._ok_positive, r._ok_small) for r in flag(df, RULES).collect()}
    assert flags == {(1, True, True), (-1, False, True), (None, False, False), (50, True, False)}


def test_observed_counts_without_another_pass(spark, tmp_path):
    df = spark.createDataFrame([(1,), (-1,), (None,), (50,)], "v int")
    kept, observation = observed(df, "t", RULES)
    kept.write.parquet(str(tmp_path / "t"))
    assert observation.get == {"rows": 4, "positive": 2, "small": 2}


def test_fail_rule_stops_the_load(spark):
    df = spark.createDataFrame([(1,), (-1,)], "v int")
    rule = (Expectation("positive", "v >= 0", "fail"),)
    assert enforce(df.filter("v > 0"), rule).count() == 1
    with pytest.raises(Exception, match="expectation positive violated"):
        enforce(df, rule).collect()


def test_unknown_action():
    with pytest.raises(ValueError, match="unknown action"):
        Expectation("x", "true", "ignore")


def test_fourteen_silver_tables():
    assert len(SPECS) == 14


def test_keys_and_versions_compare_after_conforming(spark):
    """Padding makes no second row, version 10 beats 9 as text, unreadable keys stay apart."""
    spec = ConformSpec("t", (Field("country", "c", "text"), Field("number", "n", "key"), Field("v", "v", "text")), ("c", "n"))
    rows = [("US", "1", "old", "9"), ("US ", "1", "new", "10"), ("DE", "x", "bad", "1"), ("DE", "y", "worse", "2")]
    got = conform(spark.createDataFrame(rows, "c string, n string, v string, id string"), spec).collect()
    assert sorted((r.country, r.number, r.v) for r in got if r.number) == [("US", 1, "new")]
    assert sorted(r.v for r in got if r.number is None) == ["bad", "worse"]


def test_rows_are_shuffled_as_values_not_as_text(spark, sample):
    """Stored silver ranks typed rows: no text of a date or an amount takes part in its shuffle, and the counts are as before."""
    from pyspark.sql import functions as F

    from martloom.operators.conform import observed_silver

    spec = SPECS["sales_header"]
    bronze = sample.bronze("sales_header").limit(400).withColumn("orderdate", F.when(F.col("id") % 5 == 0, "31/02/1995").otherwise(F.col("orderdate")))
    path_rows = spark.createDataFrame(bronze.collect(), bronze.schema)
    rows, read, _ = observed_silver(path_rows, spec)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    shuffled = plan[plan.index("Exchange hashpartitioning"):]
    ranked = shuffled[: shuffled.index("CollectMetrics")]
    assert "orderdate" not in ranked and "totalamount" not in ranked and "order_date" in ranked
    assert rows.count() > 0
    counts = dict(read.get)
    assert counts.pop("_rows") == path_rows.count()
    assert counts == {r.column_name: r.unreadable for r in parse_failures(path_rows, spec).collect()} and counts["order_date"] > 0
