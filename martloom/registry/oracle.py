"""Relations the checking SQL is written over: the star schema restated for DuckDB.

Money is carried as exact decimals. Where Spark divides decimals, the SQL restates the division
and its half-up rounding with whole numbers, since DuckDB divides decimals as doubles.
"""

from __future__ import annotations

from martloom.plans.rfm import ACTIONS


def money4(whole: str) -> str:
    """A whole number of ten-thousandths as DECIMAL(18,4)."""
    return f"CAST(CAST({whole} AS BIGINT) * 0.0001 AS DECIMAL(18,4))"


EXT_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
QTY = "CAST(l_quantity AS BIGINT)"
UNIT_PRICE = money4(f"({EXT_CENTS} * 200 + {QTY}) // (2 * {QTY})")
SUBCATEGORY_KEY = (
    "CAST((ascii(p_type) * 100 + length(p_type)) * 100 + CAST(substring(p_brand, 7) AS INTEGER) AS BIGINT)"
)

ACTION_ROWS = ", ".join(
    "(" + ", ".join("'" + text.replace("'", "''") + "'" for text in row) + ")" for row in ACTIONS
)

# name -> (relations it reads, SQL)
RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    "s_header": (
        (),
        """SELECT o_orderkey AS sales_header_key, o_custkey AS customer_key,
             CAST(o_custkey % 5 AS BIGINT) AS region_key, 'SO' || o_orderkey AS sales_order_number,
             CAST(o_orderdate AS DATE) AS order_date, CAST(o_orderdate AS DATE) + 30 AS due_date,
             ship_date, CAST(coalesce(discount, 0) AS DECIMAL(18,4)) AS discount_amount,
             CAST(o_totalprice AS DECIMAL(18,4)) AS total_amount,
             CAST(CAST(o_totalprice AS DECIMAL(18,4)) - coalesce(discount, 0) AS DECIMAL(18,4)) AS sales_amount
           FROM orders LEFT JOIN (
             SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS ship_date,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS discount
             FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey""",
    ),
    "s_details": (
        (),
        f"""SELECT l_orderkey * 10 + l_linenumber AS sales_details_key, l_orderkey AS sales_header_key,
             l_partkey AS product_key, 'SO' || l_orderkey AS sales_order_number,
             CAST(l_quantity AS INTEGER) AS order_quantity, {UNIT_PRICE} AS unit_price,
             CAST(l_extendedprice AS DECIMAL(18,4)) AS extended_amount, {EXT_CENTS} * 100 AS ext_i
           FROM lineitem""",
    ),
    "fct": (
        ("s_header", "s_details"),
        f"""SELECT sales_details_key, sales_header_key, customer_key, product_key, region_key,
             order_date, due_date, ship_date, sales_order_number, order_quantity, unit_price,
             extended_amount AS gross_sales,
             {money4("(alloc_i + 50) // 100")} AS discount_allocated,
             {money4("sign(ext_i * 100 - alloc_i) * ((abs(ext_i * 100 - alloc_i) + 50) // 100)")} AS net_sales,
             CAST(ship_date - order_date AS INTEGER) AS lead_time_days,
             CAST(due_date - order_date AS INTEGER) AS promised_lead_time_days,
             CAST(ship_date - due_date AS INTEGER) AS delivery_delay_days,
             ship_date > due_date AS is_late
           FROM (SELECT *, CAST((share_i * ext_i + 500000000000000000::HUGEINT) // 1000000000000000000::HUGEINT AS BIGINT) AS alloc_i
                 FROM (SELECT d.*, h.* EXCLUDE (sales_header_key, sales_order_number),
                         (CAST(discount_amount * 10000 AS HUGEINT) * 2 * 100000000000000000000::HUGEINT
                            + CAST(total_amount * 10000 AS HUGEINT)) // nullif(2 * CAST(total_amount * 10000 AS HUGEINT), 0) AS share_i
                       FROM s_details d LEFT JOIN s_header h ON d.sales_header_key = h.sales_header_key))""",
    ),
    "fct_returns": (
        (),
        f"""SELECT l_orderkey * 10 + l_linenumber AS return_key, o_custkey AS customer_key,
             l_partkey AS product_key, CAST(l_shipdate AS DATE) + 14 AS return_date,
             CAST(o_orderdate AS DATE) AS order_date, 'SO' || l_orderkey AS sales_order_number,
             CAST(l_quantity AS INTEGER) AS return_quantity, {UNIT_PRICE} AS unit_price,
             CAST(l_extendedprice AS DECIMAL(18,4)) AS return_amount
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    ),
    "cost": (
        (),
        f"""SELECT p_partkey AS product_key, n_name AS country_code, CAST(y AS INTEGER) AS year,
             CAST(m AS INTEGER) AS month_no,
             {money4("CAST(round(p_retailprice * 100) AS BIGINT) * (50 + m)")} AS unit_cost
           FROM (SELECT DISTINCT l_partkey, year(o_orderdate) AS y, month(o_orderdate) AS m, c_nationkey
                 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
                 WHERE l_returnflag <> 'N')
           JOIN part ON p_partkey = l_partkey JOIN nation ON n_nationkey = c_nationkey""",
    ),
    "place": (
        (),
        """SELECT n_nationkey AS geography_key, n_regionkey AS home_region_key, n_name AS country,
             r_name AS region_name, r_name AS continent
           FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""",
    ),
    "buyer": (
        ("place",),
        """SELECT c_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS business_type, place.*
           FROM customer JOIN place ON geography_key = c_nationkey""",
    ),
    "item": (
        (),
        f"""SELECT p_partkey AS product_key, {SUBCATEGORY_KEY} AS product_subcategory_key,
             p_type AS category_name, p_type || '/' || p_brand AS subcategory_name, p_name AS product_name,
             CAST(p_size AS VARCHAR) AS size, p_brand AS detail
           FROM part""",
    ),
    "tx": (
        ("fct", "fct_returns", "cost", "buyer", "item"),
        """SELECT 'sale' AS transaction_type, f.customer_key, f.product_key, f.region_key,
             customer_name, business_type, region_name, country, continent,
             category_name, subcategory_name, product_name, order_date,
             CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
             order_quantity AS quantity, unit_price,
             CAST(order_quantity * unit_price AS DECIMAL(18,4)) AS gross_amount,
             discount_allocated AS discount_amount, unit_cost
           FROM fct f JOIN buyer b ON b.customer_key = f.customer_key JOIN item i ON i.product_key = f.product_key
           LEFT JOIN cost c ON c.product_key = f.product_key AND c.year = year(order_date)
             AND c.month_no = month(order_date) AND c.country_code = b.country
           UNION ALL
           SELECT 'return', r.customer_key, r.product_key, home_region_key,
             customer_name, business_type, region_name, country, continent,
             category_name, subcategory_name, product_name, order_date,
             CAST(year(order_date) AS INTEGER), CAST(month(order_date) AS INTEGER),
             return_quantity, unit_price, CAST(return_quantity * unit_price AS DECIMAL(18,4)),
             CAST(0 AS DECIMAL(18,4)), NULL
           FROM fct_returns r JOIN buyer b ON b.customer_key = r.customer_key
           JOIN item i ON i.product_key = r.product_key""",
    ),
    "ledger": (
        (),
        """SELECT o_orderkey AS finance_key, CAST(o_custkey % 35 AS BIGINT) AS account_key,
             CAST(o_custkey % 9 AS BIGINT) AS organization_key, CAST(o_orderkey % 7 AS BIGINT) AS department_group_key,
             CAST(o_orderdate AS DATE) AS transaction_date,
             CASE o_orderstatus WHEN 'F' THEN 'actual' ELSE 'budget' END AS scenario,
             CAST(o_totalprice AS DECIMAL(18,4)) AS amount
           FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    ),
    "chart": (
        (),
        """SELECT CAST(k AS BIGINT) AS account_key, CAST(k % 10 + 1 AS BIGINT) AS account_header_key,
             CAST(k % 4 AS BIGINT) AS account_subheader_key, 'Account ' || k AS account_name,
             CASE WHEN k % 3 = 0 THEN 'Expense' ELSE 'Revenue' END AS account_type,
             'Subheader ' || (k % 4) AS account_subheader, CAST(k % 4 AS INTEGER) AS subheader_detail,
             CAST(CASE WHEN k % 3 = 0 THEN -1 ELSE 1 END AS INTEGER) AS sign,
             CASE WHEN k % 10 + 1 = 3 THEN 'Net Sales' ELSE 'Header ' || (k % 10 + 1) END AS account_header_name
           FROM (SELECT DISTINCT c_custkey % 35 AS k FROM customer)""",
    ),
    "stmt": (
        ("ledger", "chart"),
        """SELECT finance_key, scenario, l.account_key, account_name, account_type, account_subheader,
             account_header_key, account_header_name, CAST(account_header_key AS INTEGER) AS header_detail,
             'Unit ' || organization_key AS organization_name, 'Division ' || (organization_key % 3) AS parent_organization,
             'Department ' || department_group_key AS department_group_name, transaction_date,
             CAST(year(transaction_date) AS INTEGER) AS year, CAST(quarter(transaction_date) AS INTEGER) AS quarter,
             CAST(month(transaction_date) AS INTEGER) AS month,
             ['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro'][month(transaction_date)] AS month_name,
             amount, sign, CAST(amount * sign AS DECIMAL(18,4)) AS signed_amount
           FROM ledger l JOIN chart c ON c.account_key = l.account_key
           WHERE organization_key IN (SELECT n_nationkey % 9 FROM nation)
             AND department_group_key IN (SELECT n_nationkey % 7 FROM nation)""",
    ),
    "rfm": (
        ("fct",),
        """SELECT *, CASE WHEN r = 5 AND fm > 4 THEN 'Champions' WHEN r >= 3 AND fm > 3 THEN 'Loyal Customers'
             WHEN r >= 4 THEN 'Potential Loyalist'
             WHEN r = 3 AND fm = 1 THEN 'Promising'
             WHEN r = 3 AND fm >= 2 THEN 'Needing Attention'
             WHEN r IN (2, 3) AND fm <= 2 THEN 'About to Sleep'
             WHEN r <= 2 AND fm > 4 THEN 'At Risk'
             WHEN r <= 2 AND fm <= 2 THEN 'Hibernating' ELSE 'Lost' END AS segment
           FROM (SELECT *, (f + m) / 2 AS fm FROM (SELECT *,
             CASE WHEN recency_days > 360 THEN 1 WHEN recency_days > 270 THEN 2 WHEN recency_days > 180 THEN 3
               WHEN recency_days > 90 THEN 4 ELSE 5 END AS r,
             CAST(least(sales_orders_12m, 5) AS INTEGER) AS f,
             CASE WHEN gross_sales_12m < 10000 THEN 1 WHEN gross_sales_12m < 100000 THEN 2
               WHEN gross_sales_12m < 200000 THEN 3 WHEN gross_sales_12m < 300000 THEN 4 ELSE 5 END AS m
           FROM (SELECT customer_key, max(order_date) AS last_purchase,
                   CAST((SELECT max(order_date) FROM fct) - max(order_date) AS INTEGER) AS recency_days,
                   count(DISTINCT sales_header_key) AS sales_orders_12m, sum(gross_sales) AS gross_sales_12m
                 FROM fct WHERE order_date >= (SELECT max(order_date) FROM fct) - INTERVAL 12 MONTH
                 GROUP BY customer_key)))""",
    ),
    "action": (
        ("rfm",),
        f"""SELECT rfm.*, intent, suggested_lever, rationale, CASE WHEN base = 'Alta' OR (base = 'Média' AND m > 3) THEN 'Alta'
             WHEN base = 'Média' OR m > 3 THEN 'Média' ELSE 'Baixa' END AS priority
           FROM rfm LEFT JOIN (VALUES {ACTION_ROWS}
           ) a(name, intent, suggested_lever, rationale, base) ON name = segment""",
    ),
    "ti": (
        ("fct",),
        """SELECT CAST(ym // 100 AS INTEGER) AS year, CAST(ym AS INTEGER) AS year_month, gross_sales,
             lag(gross_sales) OVER (ORDER BY ym) AS gross_sales_prev_month,
             lag(gross_sales, 12) OVER (ORDER BY ym) AS gross_sales_prev_year
           FROM (SELECT year(order_date) * 100 + month(order_date) AS ym,
                   sum(gross_sales) AS gross_sales FROM fct GROUP BY 1)""",
    ),
    "sub_month": (
        ("fct", "item"),
        """SELECT CAST(date_trunc('month', order_date) AS DATE) AS ms, subcategory_name AS subcategory,
             sum(order_quantity) AS qty, sum(gross_sales) AS rev
           FROM fct JOIN item USING (product_key) GROUP BY 1, 2""",
    ),
    # one table shifted by 1 or 12 months meets itself in a full join; group totals are windows
    "pvm": (
        ("sub_month",),
        """SELECT comparison_type, CAST(year(ms) * 100 + month(ms) AS INTEGER) AS year_month, ms AS month_start, subcategory,
             dr AS delta_revenue, v AS effect_volume, p AS effect_price, dr - v - p AS effect_mix
           FROM (SELECT comparison_type, ms, subcategory, r_now - r_then AS dr,
                   (tq_now - tq_then) * (q_then / tq_then) * (tr_then / tq_then) AS v,
                   CASE WHEN q_now > 0 AND q_then > 0 THEN q_now * (r_now / q_now - r_then / q_then) ELSE 0 END AS p
           FROM (SELECT *, qn::DOUBLE AS q_now, rn::DOUBLE AS r_now, qt::DOUBLE AS q_then, rt::DOUBLE AS r_then,
                   CAST(sum(qn) OVER g AS DOUBLE) AS tq_now, CAST(sum(qt) OVER g AS DOUBLE) AS tq_then,
                   CAST(sum(rt) OVER g AS DOUBLE) AS tr_then, sum(seen_now) OVER g AS some_now, sum(seen_then) OVER g AS some_then
           FROM (SELECT comparison_type, ms, subcategory, coalesce(a.qty, 0) AS qn, coalesce(a.rev, 0) AS rn,
                   coalesce(b.qty, 0) AS qt, coalesce(b.rev, 0) AS rt,
                   (a.qty IS NOT NULL)::INTEGER AS seen_now, (b.qty IS NOT NULL)::INTEGER AS seen_then
                 FROM (SELECT 'MoM' AS comparison_type, * FROM sub_month UNION ALL SELECT 'YoY', * FROM sub_month) a
                 FULL JOIN (SELECT 'MoM' AS comparison_type, * REPLACE (CAST(ms + INTERVAL 1 MONTH AS DATE) AS ms) FROM sub_month
                            UNION ALL SELECT 'YoY', * REPLACE (CAST(ms + INTERVAL 1 YEAR AS DATE) AS ms) FROM sub_month) b
                 USING (comparison_type, ms, subcategory))
           WINDOW g AS (PARTITION BY comparison_type, ms))
           WHERE some_now > 0 AND some_then > 0)""",
    ),
    "bill": (
        (),
        """SELECT event_type AS sku_name, 'product ' || event_type AS billing_origin_product,
             CAST(value AS DECIMAL(18,2)) AS usage_quantity, ts AS usage_start_time,
             ts + INTERVAL 1 HOUR AS usage_end_time, CAST(ts AS DATE) AS usage_date,
             CAST(props ->> '$.k' AS VARCHAR) AS tag, user_id
           FROM events""",
    ),
}


def _with_sources(names: tuple[str, ...], seen: dict[str, str]) -> None:
    for name in names:
        if name not in seen:
            sources, sql = RELATIONS[name]
            _with_sources(sources, seen)
            seen[name] = sql


def compose(sql: str, reads: tuple[str, ...]) -> str:
    """``sql`` preceded by the relations it reads, sources first."""
    seen: dict[str, str] = {}
    _with_sources(reads, seen)
    if not seen:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in seen.items()) + "\n" + sql


def doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def texts(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns)


def sql_ratio(numerator: str, denominator: str) -> str:
    return f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0)"


# Measures restated over ``tx`` and ``stmt``.
GROSS = "sum(gross_amount) FILTER (WHERE transaction_type = 'sale')"
RETURNS = "sum(gross_amount) FILTER (WHERE transaction_type = 'return')"
DISCOUNTS = "sum(discount_amount)"
COST = "sum(quantity * unit_cost) FILTER (WHERE transaction_type = 'sale')"
QUANTITY = "CAST(sum(quantity) FILTER (WHERE transaction_type = 'sale') AS BIGINT)"
CUSTOMERS = "count(DISTINCT customer_key) FILTER (WHERE transaction_type = 'sale')"
NET = f"(coalesce({GROSS}, 0) - coalesce({DISCOUNTS}, 0) - coalesce({RETURNS}, 0))"
MARGIN = f"({NET} - coalesce({COST}, 0))"
MARGIN_PCT = sql_ratio(f"(coalesce({GROSS}, 0) - coalesce({COST}, 0))", GROSS)
NET_MARGIN_PCT = sql_ratio(MARGIN, NET)
RETURNS_PCT = sql_ratio(f"coalesce({RETURNS}, 0)", GROSS)


def _sale_avg(column: str) -> str:
    only = "FILTER (WHERE transaction_type = 'sale')"
    return f"CAST(sum({column}) {only} AS DOUBLE) / nullif(CAST(count({column}) {only} AS DOUBLE), 0)"


AVG_PRICE, AVG_COST = _sale_avg("unit_price"), _sale_avg("unit_cost")
ACTUAL = "sum(signed_amount) FILTER (WHERE scenario = 'actual')"
BUDGET = "sum(signed_amount) FILTER (WHERE scenario = 'budget')"
DEVIATION = f"(coalesce({ACTUAL}, 0) - coalesce({BUDGET}, 0))"


def as_double(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"
