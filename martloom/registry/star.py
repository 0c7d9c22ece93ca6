"""Gold tables and the joins behind them."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.registry.core import Context, query
from martloom.registry.oracle import SUBCATEGORY_KEY, doubles, texts


@query(
    "dim_customer",
    "SELECT c_custkey AS customer_key, CAST(c_nationkey AS BIGINT) AS geography_key, c_name AS customer_name,"
    " c_mktsegment AS business_type, CAST(c_custkey % 500 AS INTEGER) AS number_employees, c_acctbal AS annual_revenue,"
    " CAST(1990 + c_custkey % 30 AS INTEGER) AS year_opened FROM customer",
)
def dim_customer(c: Context):
    return c.gold("dim_customer")


@query(
    "dim_geography",
    "SELECT CAST(geography_key AS BIGINT) AS geography_key, CAST(home_region_key AS BIGINT) AS region_key, continent,"
    " region_name, country AS country_code, country AS country_name, country AS state_code, country AS state_name,"
    " country AS city_name FROM place",
    ("place",),
)
def dim_geography(c: Context):
    return c.gold("dim_geography")


@query(
    "dim_product",
    "SELECT product_key, product_subcategory_key, category_name, subcategory_name, product_name, size, detail FROM item",
    ("item",),
)
def dim_product(c: Context):
    return c.gold("dim_product")


@query(
    "dim_account",
    "SELECT account_key, account_header_key, account_subheader_key, account_name, account_type, account_subheader,"
    " subheader_detail, sign FROM chart",
    ("chart",),
)
def dim_account(c: Context):
    return c.gold("dim_account")


@query(
    "dim_account_header",
    "SELECT DISTINCT account_header_key, account_header_name, CAST(account_header_key AS INTEGER) AS header_detail FROM chart",
    ("chart",),
)
def dim_account_header(c: Context):
    return c.gold("dim_account_header")


@query(
    "dim_organization",
    "SELECT CAST(k AS BIGINT) AS organization_key, 'Unit ' || k AS organization_name, 'Division ' || (k % 3) AS parent_organization"
    " FROM (SELECT DISTINCT n_nationkey % 9 AS k FROM nation)",
)
def dim_organization(c: Context):
    return c.gold("dim_organization")


@query(
    "dim_department_group",
    "SELECT CAST(k AS BIGINT) AS department_group_key, 'Department ' || k AS department_group_name"
    " FROM (SELECT DISTINCT n_nationkey % 7 AS k FROM nation)",
)
def dim_department_group(c: Context):
    return c.gold("dim_department_group")


@query(
    "dim_region",
    "SELECT CAST(r_regionkey AS BIGINT) AS region_key, r_name AS region_name, r_name AS country, r_name AS continent FROM region",
)
def dim_region(c: Context):
    return c.gold("dim_region")


@query(
    "dim_calendar",
    """, bound AS (SELECT min(d) AS low, max(d) AS high FROM (
         SELECT transaction_date AS d FROM ledger UNION ALL SELECT order_date FROM s_header
         UNION ALL SELECT due_date FROM s_header UNION ALL SELECT ship_date FROM s_header
         UNION ALL SELECT return_date FROM fct_returns UNION ALL SELECT order_date FROM fct_returns)),
       span AS (SELECT CAST(unnest(generate_series(make_date(year(low), 1, 1), make_date(year(high), 12, 31), INTERVAL 1 DAY)) AS DATE) AS d FROM bound)
       SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, CAST(d AS VARCHAR) AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
         CASE month(d) WHEN 1 THEN 'Janeiro' WHEN 2 THEN 'Fevereiro' WHEN 3 THEN 'Março' WHEN 4 THEN 'Abril'
           WHEN 5 THEN 'Maio' WHEN 6 THEN 'Junho' WHEN 7 THEN 'Julho' WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Setembro'
           WHEN 10 THEN 'Outubro' WHEN 11 THEN 'Novembro' ELSE 'Dezembro' END AS month_name,
         CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
         CAST(weekofyear(d) AS INTEGER) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend
       FROM span""",
    ("ledger", "s_header", "fct_returns"),
)
def dim_calendar(c: Context):
    return c.gold("dim_calendar")


@query(
    "fct_finance",
    "SELECT finance_key, account_key, organization_key, department_group_key, scenario, "
    + texts("transaction_date") + ", " + doubles("amount") + " FROM ledger",
    ("ledger",),
)
def fct_finance(c: Context):
    return c.gold("fct_finance")


@query(
    "fct_sales_details",
    "SELECT sales_details_key, sales_header_key, customer_key, product_key, region_key, sales_order_number, order_quantity,"
    " lead_time_days, promised_lead_time_days, delivery_delay_days, is_late, "
    + texts("order_date", "due_date", "ship_date") + ", "
    + doubles("unit_price", "gross_sales", "discount_allocated", "net_sales") + " FROM fct",
    ("fct",),
)
def fct_sales_details(c: Context):
    return c.gold("fct_sales_details")


@query(
    "discount_allocation",
    """SELECT sales_header_key, CAST(sum(gross_sales) AS DOUBLE) AS gross_sales, CAST(sum(discount_allocated) AS DOUBLE) AS discount_allocated,
         CAST(sum(net_sales) AS DOUBLE) AS net_sales, count(*) AS line_count FROM fct GROUP BY 1""",
    ("fct",),
)
def discount_allocation(c: Context):
    return c.gold("fct_sales_details").groupBy("sales_header_key").agg(
        F.sum("gross_sales").alias("gross_sales"),
        F.sum("discount_allocated").alias("discount_allocated"),
        F.sum("net_sales").alias("net_sales"),
        F.count(F.lit(1)).alias("line_count"),
    )


@query(
    "lead_time",
    """SELECT CAST(year(order_date) AS INTEGER) AS order_year, is_late, count(*) AS line_count,
         avg(lead_time_days) AS lead_time, avg(promised_lead_time_days) AS promised, avg(delivery_delay_days) AS delay
       FROM fct GROUP BY 1, 2""",
    ("fct",),
)
def lead_time(c: Context):
    return c.gold("fct_sales_details").groupBy(F.year("order_date").alias("order_year"), "is_late").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.avg("lead_time_days").alias("lead_time"),
        F.avg("promised_lead_time_days").alias("promised"),
        F.avg("delivery_delay_days").alias("delay"),
    )


@query(
    "fct_sales_returns",
    "SELECT return_key, customer_key, product_key, sales_order_number, return_quantity, "
    + texts("return_date", "order_date") + ", " + doubles("unit_price", "return_amount") + " FROM fct_returns",
    ("fct_returns",),
)
def fct_sales_returns(c: Context):
    return c.gold("fct_sales_returns")


@query(
    "fct_cost_history",
    "SELECT product_key, year, month_no, country_code, " + doubles("unit_cost") + " FROM cost",
    ("cost",),
)
def fct_cost_history(c: Context):
    return c.gold("fct_product_cost_history")


@query(
    "subcategories",
    f"SELECT DISTINCT {SUBCATEGORY_KEY} AS product_subcategory_key, p_type || '/' || p_brand AS subcategory_name,"
    " p_type AS category_name FROM part",
)
def subcategories(c: Context):
    return c.mart.silver("product_sub_category")
