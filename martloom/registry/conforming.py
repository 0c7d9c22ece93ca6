"""Raw source text through cleaning, parsing, deduplication and the declared rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.conform import ConformSpec, Field, conform, keep_latest, parse_failures, to_silver
from martloom.operators.quality import Expectation, enforce, flag, quality_report
from martloom.plans.silver import SPECS
from martloom.registry.core import QUERIES, Context, query
from martloom.registry.oracle import EXT_CENTS, SUBCATEGORY_KEY, compose, doubles, texts

# The line content that numbers the versions of a repeated order line.
LINE_ID = f"(l_partkey * 100000000 + {EXT_CENTS}) * 2 + 1"
LATEST_LINE = (
    f"QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ID} DESC) = 1"
)


def _silver(table: str, sql: str, reads: tuple[str, ...] = ()) -> None:
    @query(f"silver_{table}", sql, reads)
    def build(c: Context) -> DataFrame:
        return to_silver(c.sample.bronze(table), SPECS[table])


_silver(
    "customer",
    "SELECT c_custkey AS customer_key, CAST(c_nationkey AS BIGINT) AS geography_key, c_name AS customer_name,"
    " c_mktsegment AS business_type, CAST(c_custkey % 500 AS INTEGER) AS number_employees, c_acctbal AS annual_revenue,"
    " CAST(1990 + c_custkey % 30 AS INTEGER) AS year_opened, c_custkey * 2 + 1 AS _source_id FROM customer WHERE c_acctbal >= 0",
)
_silver(
    "account",
    "SELECT account_key, account_header_key, account_subheader_key, account_name, account_type, account_subheader,"
    " subheader_detail, sign, account_key * 2 + 1 AS _source_id FROM chart",
    ("chart",),
)
_silver(
    "account_header",
    "SELECT DISTINCT account_header_key, account_header_name, CAST(account_header_key AS INTEGER) AS header_detail,"
    " account_header_key * 2 + 1 AS _source_id FROM chart",
    ("chart",),
)
_silver(
    "organization",
    "SELECT CAST(k AS BIGINT) AS organization_key, 'Unit ' || k AS organization_name, 'Division ' || (k % 3) AS parent_organization,"
    " CAST(k * 2 + 1 AS BIGINT) AS _source_id FROM (SELECT DISTINCT n_nationkey % 9 AS k FROM nation)",
)
_silver(
    "department_group",
    "SELECT CAST(k AS BIGINT) AS department_group_key, 'Department ' || k AS department_group_name,"
    " CAST(k * 2 + 1 AS BIGINT) AS _source_id FROM (SELECT DISTINCT n_nationkey % 7 AS k FROM nation)",
)
_silver(
    "geography",
    "SELECT CAST(n_nationkey AS BIGINT) AS geography_key, CAST(n_regionkey AS BIGINT) AS region_key, n_name AS city_name,"
    " n_name AS state_code, n_name AS state_name, n_name AS country_code, n_name AS country_name,"
    " CAST(n_nationkey * 2 + 1 AS BIGINT) AS _source_id FROM nation",
)
_silver(
    "region",
    "SELECT CAST(r_regionkey AS BIGINT) AS region_key, r_name AS region_name, r_name AS country, r_name AS continent,"
    " CAST(r_regionkey * 2 + 1 AS BIGINT) AS _source_id FROM region",
)
_silver(
    "product",
    "SELECT product_key, product_subcategory_key, product_name, size, detail, product_key * 2 + 1 AS _source_id FROM item",
    ("item",),
)
_silver(
    "product_sub_category",
    f"SELECT k AS product_subcategory_key, subcategory_name, category_name, k * 2 + 1 AS _source_id FROM (SELECT DISTINCT"
    f" {SUBCATEGORY_KEY} AS k, p_type || '/' || p_brand AS subcategory_name, p_type AS category_name FROM part)",
)
_silver(
    "finance",
    "SELECT finance_key, account_key, organization_key, department_group_key, scenario, "
    + texts("transaction_date") + ", " + doubles("amount") + ", finance_key * 2 + 1 AS _source_id FROM ledger",
    ("ledger",),
)
_silver(
    "sales_header",
    "SELECT sales_header_key, customer_key, region_key, sales_order_number, " + texts("order_date", "due_date", "ship_date")
    + ", " + doubles("discount_amount", "total_amount", "sales_amount") + ", sales_header_key * 2 + 1 AS _source_id FROM s_header",
    ("s_header",),
)
LINE_PRICE = f"CAST(({EXT_CENTS} * 200 + CAST(l_quantity AS BIGINT)) // (2 * CAST(l_quantity AS BIGINT)) AS DOUBLE) / 10000 AS unit_price"
_silver(
    "sales_details",
    "SELECT l_orderkey * 10 + l_linenumber AS sales_details_key, l_orderkey AS sales_header_key, l_partkey AS product_key,"
    " l_partkey % 150 AS product_subcategory_key, 'SO' || l_orderkey AS sales_order_number,"
    f" CAST(l_quantity AS INTEGER) AS order_quantity, {LINE_PRICE}, l_extendedprice AS extended_amount,"
    f" {LINE_ID} AS _source_id FROM lineitem {LATEST_LINE}",
)
_silver(
    "sales_returns",
    "SELECT l_orderkey * 10 + l_linenumber AS return_key, o_custkey AS customer_key, l_partkey AS product_key,"
    " 'SO' || l_orderkey AS sales_order_number, CAST(CAST(l_shipdate AS DATE) + 14 AS VARCHAR) AS return_date,"
    " CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, CAST(l_quantity AS INTEGER) AS return_quantity,"
    f" {LINE_PRICE}, l_extendedprice AS return_amount, {LINE_ID} AS _source_id"
    f" FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R' {LATEST_LINE}",
)
_silver(
    "product_cost_history",
    "SELECT product_key, country_code, year, month_no, " + doubles("unit_cost") + ", product_key * 2 + 1 AS _source_id FROM cost",
    ("cost",),
)


@query(
    "dedup_latest",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date"
    " FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber"
    " ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1",
)
def dedup_latest(c: Context):
    latest = keep_latest(
        c.sample.read("lineitem"), ("l_orderkey", "l_linenumber"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice",
    )
    return latest.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("ship_date"),
    )


@query(
    "dq_drop",
    "SELECT c_custkey AS customer_key, c_acctbal AS annual_revenue FROM customer WHERE c_acctbal >= 0",
)
def dq_drop(c: Context):
    return enforce(c.mart.silver("customer"), SPECS["customer"].rules).select("customer_key", "annual_revenue")


# Tracked rules the sample data really breaks.
TRACKED = (
    Expectation("ships_after_order", "ship_date >= order_date", "track"),
    Expectation("ships_in_time", "ship_date <= due_date", "track"),
)


@query(
    "dq_track",
    "SELECT sales_header_key, coalesce(ship_date >= order_date, false) AS _ok_ships_after_order,"
    " coalesce(ship_date <= due_date, false) AS _ok_ships_in_time FROM s_header",
    ("s_header",),
)
def dq_track(c: Context):
    kept = enforce(flag(c.mart.silver("sales_header"), TRACKED), TRACKED)
    return kept.select("sales_header_key", "_ok_ships_after_order", "_ok_ships_in_time")


def _report_sql(table: str, relation: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS rule_name, '{action}' AS action,"
        f" count(*) FILTER (WHERE {condition}) AS passed, count(*) FILTER (WHERE ({condition}) IS NOT TRUE) AS failed FROM {relation}"
        for name, action, condition in rules
    )


def all_reports_sql() -> str:
    """Every rule of every silver table. Where a rule drops rows of the sample, the source stands in."""
    sources = {
        "customer": ("customer", {"customer_key": "c_custkey", "annual_revenue": "c_acctbal"}),
        "finance": ("orders", {"finance_key": "o_orderkey", "scenario": "CASE o_orderstatus WHEN 'F' THEN 'actual' WHEN 'O' THEN 'budget' END"}),
    }
    rules = {
        "customer": [("valid_key", "drop", "customer_key IS NOT NULL"), ("valid_revenue", "drop", "annual_revenue >= 0")],
        "finance": [("valid_key", "drop", "finance_key IS NOT NULL"), ("valid_scenario", "drop", "scenario IN ('actual', 'budget')")],
        "sales_header": [("valid_key", "drop", "sales_header_key IS NOT NULL"), ("valid_total", "track", "total_amount >= 0")],
        "sales_details": [
            ("valid_key", "drop", "sales_details_key IS NOT NULL"), ("valid_quantity", "track", "order_quantity >= 0"),
            ("valid_price", "track", "unit_price >= 0"),
        ],
        "sales_returns": [("valid_key", "drop", "return_key IS NOT NULL"), ("valid_quantity", "track", "return_quantity >= 0")],
        "product_cost_history": [("valid_product", "drop", "product_key IS NOT NULL"), ("valid_cost", "track", "unit_cost >= 0")],
    }
    keys = {
        "account": "account_key", "account_header": "account_header_key", "organization": "organization_key",
        "department_group": "department_group_key", "geography": "geography_key", "region": "region_key",
        "product": "product_key", "product_sub_category": "product_subcategory_key",
    }
    rules |= {t: [("valid_key", "drop", f"{k} IS NOT NULL")] for t, k in keys.items()}
    parts = []
    for table, checks in rules.items():
        relation, columns = sources.get(table, (None, {}))
        if columns:
            relation = f"(SELECT {', '.join(f'{e} AS {n}' for n, e in columns.items())} FROM {relation})"
        parts.append(_report_sql(table, relation or f"({QUERIES[f'silver_{table}'].sql})", checks))
    return " UNION ALL ".join(parts)


@query(
    "dq_report",
    all_reports_sql() + " UNION ALL SELECT * FROM (" + compose(_report_sql("orders_shipping", "s_header", [
        ("ships_after_order", "track", "ship_date >= order_date"), ("ships_in_time", "track", "ship_date <= due_date"),
    ]), ("s_header",)) + ")",
)
def dq_report(c: Context):
    reports = [quality_report(conform(c.sample.bronze(t), spec), t, spec.rules) for t, spec in SPECS.items()]
    reports.append(quality_report(c.mart.silver("sales_header"), "orders_shipping", TRACKED))
    return reduce(DataFrame.unionByName, reports)


@query(
    "dq_parse_failures",
    """SELECT 'documents' AS table_name, 'amount' AS column_name,
         count(*) FILTER (WHERE trim(lang) <> '') AS unreadable FROM documents
       UNION ALL SELECT 'documents', 'size', count(*) FILTER (WHERE n_chars IS NOT NULL AND TRY_CAST(n_chars AS INTEGER) IS NULL) FROM documents""",
)
def dq_parse_failures(c: Context):
    """Language codes read as money never parse, character counts always do."""
    spec = ConformSpec(
        "documents", (Field("amount", "lang", "money"), Field("size", "n_chars", "int")), ("doc_id",)
    )
    return parse_failures(c.sample.read("documents"), spec)
