"""What the physical plans look like: pushdown, codegen, skew handling, no Python."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from martloom.plans import gold
from martloom.plans.semantic import sales_transactions
from martloom.registry import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("export", "ingest", "copy", "stream"))))
def test_no_python_and_no_cartesian_product(spark, sf_dir, name):
    plan = _plan(QUERIES[name].run(spark, sf_dir))
    for slow in ("Python", "Pandas", "CartesianProduct"):
        assert slow not in plan, slow


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = _plan(QUERIES["scan_parquet"].run(spark, sf_dir))
    assert "GreaterThan(l_quantity,45.0)" in plan
    assert "l_discount" not in plan
    plan = _plan(QUERIES["incremental_watermark"].run(spark, sf_dir))
    assert "GreaterThan(o_orderdate," in plan


def test_region_filter_reaches_the_region_scan(spark, sf_dir):
    assert "EqualTo(r_name,ASIA)" in _plan(QUERIES["tq_net_sales_region_param"].run(spark, sf_dir))


def test_facts_are_read_once_for_price_volume_mix(spark, sf_dir):
    plan = _plan(QUERIES["pvm_drivers"].run(spark, sf_dir))
    assert plan.count("l_extendedprice") > 0
    assert sum("FileScan" in line and "l_extendedprice" in line for line in plan.splitlines()) == 1


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _lines(spark, hot: str):
    """Ninety thousand lines, a third of them on one order (7) or one customer's orders."""
    return spark.range(90_000).repartition(16).selectExpr(
        "id AS sales_details_key", f"CASE WHEN id < 30000 THEN {hot} ELSE id % 20000 END AS sales_header_key",
        "id % 50 AS product_key", "concat('SO', id) AS sales_order_number", "CAST(id % 9 AS INT) AS order_quantity",
        "CAST(id % 17 AS DECIMAL(18,4)) AS unit_price", "CAST(id % 13 AS DECIMAL(18,4)) AS extended_amount",
    )


def _header(spark):
    """Orders 10000 and above belong to customer 3."""
    return spark.range(20_000).selectExpr(
        "id AS sales_header_key", "CASE WHEN id >= 10000 THEN 3 ELSE id END AS customer_key", "1L AS region_key",
        "DATE '2024-01-01' AS order_date", "DATE '2024-01-02' AS due_date", "DATE '2024-01-03' AS ship_date",
        "CAST(1 AS DECIMAL(18,4)) AS discount_amount", "CAST(id % 10 + 5 AS DECIMAL(18,4)) AS total_amount",
    )


def _same_without_splitting(spark, rows):
    """The query's rows, after checking that AQE split a side and that splitting changed nothing."""
    got = sorted(rows.collect())
    assert "skew=true" in _plan(rows)
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        assert sorted(rows.select("*").collect()) == got
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    return got


def test_an_order_with_a_third_of_all_lines_is_split(spark, small_skew_limits):
    fact = gold.fct_sales_details(_lines(spark, "7"), _header(spark))
    rows = fact.groupBy("is_late").agg(F.count("*").alias("n"), F.sum("net_sales").alias("net"))
    assert _same_without_splitting(spark, rows)[0].n == 90_000


def test_a_customer_with_most_lines_is_split(spark, small_skew_limits):
    sales = gold.fct_sales_details(_lines(spark, "id % 10000 + 10000"), _header(spark))
    customer = spark.range(10_000).selectExpr(
        "id AS customer_key", "id % 5 AS geography_key", "concat('customer ', id) AS customer_name", "'Gym' AS business_type"
    )
    geography = spark.range(5).selectExpr(
        "id AS geography_key", "id AS region_key", "'K' AS continent", "concat('R', id) AS region_name", "'C' AS country_code",
        "'C' AS country_name", "'S' AS state_name", "'T' AS city_name",
    )
    product = spark.range(50).selectExpr(
        "id AS product_key", "'Cat' AS category_name", "'Sub' AS subcategory_name", "concat('P', id) AS product_name"
    )
    returns = spark.createDataFrame(
        [], "return_key long, customer_key long, product_key long, return_date date, order_date date,"
        " return_quantity int, unit_price decimal(18,4)"
    )
    view = sales_transactions(sales, returns, customer, geography, product, None)
    rows = view.groupBy("region_name").agg(F.count("*").alias("n"), F.sum("gross_amount").alias("gross"))
    assert sum(r.n for r in _same_without_splitting(spark, rows)) == 90_000


def test_the_sample_header_joins_through_plain_shuffles(spark, sf_dir, small_skew_limits):
    """Both sides of the line-to-order join are shuffles, the form AQE can split."""
    df = QUERIES["fct_sales_details"].run(spark, sf_dir)
    df.count()
    top = [line for line in _plan(df).splitlines() if "Exchange hashpartitioning(sales_header_key" in line]
    assert len(top) >= 2


def test_lines_are_shuffled_by_product_once_for_costs_and_products(spark, sf_dir, small_skew_limits):
    for name in ("v_sales_transactions", "measures_composed"):
        plan = _plan(QUERIES[name].run(spark, sf_dir))
        assert not re.search(r"hashpartitioning\(product_key#\w+, order_year", plan), name
        assert plan.count("REPARTITION_BY_COL") >= 1


def test_distinct_customers_do_not_carry_the_other_sums(spark, sf_dir):
    assert "Expand" in _plan(QUERIES["measures_composed"].run(spark, sf_dir))


def test_lines_of_known_products_are_not_summed_by_product(spark, sf_dir, small_skew_limits):
    plan = _plan(QUERIES["measures_by_customer"].run(spark, sf_dir))
    assert not re.search(r"city_name#\w+, product_key#\w+, \d+\)", plan)


def test_costs_stay_with_their_product_for_the_grain(spark, sf_dir, small_skew_limits):
    plan = _plan(QUERIES["grain_summary"].run(spark, sf_dir))
    assert not re.search(r"hashpartitioning\(p_partkey#\w+, year", plan)
