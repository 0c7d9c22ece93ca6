from __future__ import annotations

from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martloom.operators import checks
from martloom.plans import commercial, gold, semantic
from martloom.plans.contracts import CONTRACTS, tables_for
from martloom.plans.metrics import MetricView

HEADER = (
    "sales_header_key long, customer_key long, region_key long, order_date date, due_date date, ship_date date,"
    " discount_amount decimal(18,4), total_amount decimal(18,4)"
)
DETAILS = (
    "sales_details_key long, sales_header_key long, product_key long, sales_order_number string, order_quantity int,"
    " unit_price decimal(18,4), extended_amount decimal(18,4)"
)


def _facts(spark):
    d = date(2024, 3, 1)
    header = spark.createDataFrame(
        [
            (1, 10, 1, d, date(2024, 3, 11), date(2024, 3, 15), Decimal(10), Decimal(30)),
            (2, 10, 1, d, d, d, Decimal(5), Decimal(0)),
            (3, 10, 1, d, d, None, None, Decimal(50)),
        ],
        HEADER,
    )
    details = spark.createDataFrame(
        [
            (11, 1, 100, "SO1", 1, Decimal(10), Decimal(10)),
            (12, 1, 100, "SO1", 2, Decimal(10), Decimal(20)),
            (21, 2, 100, "SO2", 1, Decimal(7), Decimal(7)),
            (31, 3, 100, "SO3", 1, Decimal(8), Decimal(8)),
            (41, 4, 100, "SO4", 1, Decimal(9), Decimal(9)),
            (None, 1, 100, "SO1", 1, Decimal(1), Decimal(1)),
        ],
        DETAILS,
    )
    return gold.fct_sales_details(details, header)


def test_discount_allocation(spark):
    rows = {r.sales_details_key: r for r in _facts(spark).collect()}
    assert set(rows) == {11, 12, 21, 31, 41}
    assert (rows[11].discount_allocated, rows[11].net_sales) == (Decimal("3.3333"), Decimal("6.6667"))
    assert rows[12].discount_allocated == Decimal("6.6667")
    for key in (21, 31, 41):  # total zero, discount missing, no order
        assert rows[key].discount_allocated is None and rows[key].net_sales is None
        assert rows[key].gross_sales is not None
    assert rows[41].customer_key is None


def test_lead_times(spark):
    rows = {r.sales_details_key: r for r in _facts(spark).collect()}
    assert (rows[11].lead_time_days, rows[11].promised_lead_time_days, rows[11].delivery_delay_days, rows[11].is_late) == (14, 10, 4, True)
    assert rows[21].is_late is False
    assert rows[31].lead_time_days is None and rows[31].is_late is None


def test_contract_order_types_and_comments(spark):
    fact = _facts(spark)
    contract = CONTRACTS["fct_sales_details"]
    assert fact.dtypes == [(c.name, c.type) for c in contract.columns]
    assert all(f.metadata["comment"] for f in fact.schema)


def test_audit_column(spark):
    region = spark.createDataFrame([(1, "R", "C", "K")], "region_key long, region_name string, country string, continent string")
    assert gold.projection("dim_region", region, F.current_timestamp()).columns[-1] == "_gold_loaded_at"


def test_calendar_spans_whole_years(spark):
    finance = spark.createDataFrame([(date(2023, 5, 5),), (None,)], "transaction_date date")
    header = spark.createDataFrame([(date(2024, 1, 1), None, date(2024, 2, 2))], "order_date date, due_date date, ship_date date")
    returns = spark.createDataFrame([], "return_date date, order_date date")
    days = gold.dim_calendar(finance, header, returns)
    assert days.count() == 365 + 366
    row = days.filter("date_key = 20240101").first()
    assert (row.month_name, row.day_of_week, row.week_of_year, row.is_weekend, row.quarter) == ("Janeiro", 2, 1, False, 1)
    assert checks.grain_violations(days, ["full_date"]).count() == 0


def test_calendar_without_dates_is_empty(spark):
    none = spark.createDataFrame([], "transaction_date date, order_date date, due_date date, ship_date date, return_date date")
    assert gold.dim_calendar(none, none, none).count() == 0


def _dimensions(spark):
    customer = spark.createDataFrame([(10, 5, "Ann", "Gym")], "customer_key long, geography_key long, customer_name string, business_type string")
    geography = spark.createDataFrame(
        [(5, 77, "K", "South", "BR", "Brazil", "S", "City")],
        "geography_key long, region_key long, continent string, region_name string, country_code string, country_name string, state_name string, city_name string",
    )
    product = spark.createDataFrame([(100, "Cat", "Sub", "Prod")], "product_key long, category_name string, subcategory_name string, product_name string")
    cost = spark.createDataFrame([(100, 2024, 3, "BR", Decimal("2.5"))], "product_key long, year int, month_no int, country_code string, unit_cost decimal(18,4)")
    returns = spark.createDataFrame(
        [(1, 10, 100, date(2024, 4, 1), date(2024, 3, 1), 1, Decimal(10)), (2, 99, 100, date(2024, 4, 1), date(2024, 3, 1), 1, Decimal(10))],
        "return_key long, customer_key long, product_key long, return_date date, order_date date, return_quantity int, unit_price decimal(18,4)",
    )
    return returns, customer, geography, product, cost


def test_region_key_and_region_name_have_different_sources(spark):
    view = semantic.sales_transactions(_facts(spark), *_dimensions(spark))
    sale = view.filter("transaction_type = 'sale'").first()
    back = view.filter("transaction_type = 'return'").collect()
    assert (sale.region_key, sale.region_name, sale.unit_cost) == (1, "South", Decimal("2.5000"))
    assert [(r.region_key, r.unit_cost, r.discount_amount) for r in back] == [(77, None, Decimal(0))]
    assert view.filter("transaction_type = 'sale'").count() == 4  # the line without an order has no buyer


def test_leaving_the_cost_out_changes_only_the_cost(spark):
    returns, customer, geography, product, cost = _dimensions(spark)
    full = semantic.sales_transactions(_facts(spark), returns, customer, geography, product, cost)
    lean = semantic.sales_transactions(_facts(spark), returns, customer, geography, product, None)
    assert full.schema == lean.schema
    assert sorted(map(str, full.drop("unit_cost").collect())) == sorted(map(str, lean.drop("unit_cost").collect()))


def test_orphans(spark):
    _, customer, *_ = _dimensions(spark)
    audit = checks.orphan_audit(_facts(spark), [("dim_customer", customer, "customer_key")]).first()
    assert (audit.orphan_keys, audit.orphan_rows) == (1, 1)  # the missing customer


def test_domains():
    assert "fct_finance" in tables_for("financeiro") and "fct_finance" not in tables_for("comercial")
    assert "dim_calendar" in tables_for("comercial") and "dim_calendar" in tables_for("financeiro")
    assert CONTRACTS["dim_customer"].tags() == {"domain": "comercial", "pii": "true"}
    assert len(CONTRACTS) == 13


@pytest.mark.parametrize("by", [(), ("Regiao",), ("Ano", "Mes"), ("Categoria", "Cidade"), ("Produto",), ("Data",), ("Cliente", "Subcategoria")])
def test_summed_lines_give_the_same_measures(sample, by):
    mart = sample.mart()
    lines = MetricView("lines", lambda o: mart.sales_transactions("unit_cost" in o), commercial.DIMENSIONS, commercial.MEASURES)
    names = {f"m{i}": m.name for i, m in enumerate(commercial.MEASURES)}
    keys = {f"k{i}": d for i, d in enumerate(by)}
    where = (lambda d: d("Pais") != "FRANCE") if len(by) % 2 else None
    want, got = (v.query(names, keys, where).collect() for v in (lines, commercial.commercial_view(mart)))
    assert sorted(map(str, (tuple(map(float_or_text, r)) for r in got))) == sorted(map(str, (tuple(map(float_or_text, r)) for r in want)))
    assert want


def float_or_text(value):
    return float(value) if isinstance(value, Decimal) else value


def test_lines_are_summed_before_they_meet_the_products(sample):
    plan = commercial.commercial_view(sample.mart()).query({"n": "Net Sales"}, {"r": "Regiao"})
    lines = plan._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = [i for i, line in enumerate(lines) if "Join Inner, (product_key" in line]
    assert len(above) == 2 and all("Aggregate [" in lines[i + 1] for i in above)  # sales and returns


def test_costs_are_found_as_by_a_left_join(spark):
    """Repeated costs repeat the sale, a cost without a value is one, and a key without a value finds none."""
    sold = spark.createDataFrame(
        [(1, 2024, 1, "A", 7), (1, 2024, 2, "A", 8), (2, 2024, 1, None, 9), (None, 2024, 1, "A", 10), (3, 2024, 1, "A", 11), (1, 2024, 1, "A", 7)],
        "product_key long, order_year int, order_month int, country_code string, quantity int",
    )
    history = spark.createDataFrame(
        [(1, 2024, 1, "A", 1), (1, 2024, 1, "A", 2), (2, 2024, 1, None, 3), (None, 2024, 1, "A", 4), (3, 2024, 1, "A", None), (9, 2024, 1, "A", 5)],
        "product_key long, year int, month_no int, country_code string, unit_cost int",
    )
    joined = sold.join(
        history.withColumnsRenamed({"year": "order_year", "month_no": "order_month"}),
        ["product_key", "order_year", "order_month", "country_code"], "left",
    )
    got = semantic._costed(sold, history).select(joined.columns)
    assert Counter(got.collect()) == Counter(joined.collect()) and got.count() == 8


def test_places_found_at_the_end_are_those_found_at_first(spark):
    returns, customer, geography, product, cost = _dimensions(spark)
    places = geography.unionByName(geography).unionByName(geography.withColumn("city_name", F.lit("Other")))
    args = (_facts(spark), returns, customer, places, product, cost)
    early = semantic.sales_transactions(*args)
    late = semantic.with_places(semantic.sales_transactions(*args, brief=True), places)
    assert late.schema == early.schema and early.count() == 3 * 5
    assert Counter(late.collect()) == Counter(early.collect())
