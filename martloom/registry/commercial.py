"""Commercial metric view: measures and certified questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.plans import growth, rfm
from martloom.registry.core import Context, query
from martloom.registry.oracle import (
    AVG_COST, AVG_PRICE, COST, CUSTOMERS, DISCOUNTS, GROSS, MARGIN, MARGIN_PCT, NET,
    NET_MARGIN_PCT, QUANTITY, RETURNS, RETURNS_PCT, as_double, doubles, sql_ratio,
)

REGION = "ASIA"
SEGMENT = "Champions"


@query(
    "v_sales_transactions",
    "SELECT transaction_type, customer_key, product_key, CAST(region_key AS BIGINT) AS region_key, customer_name,"
    " business_type, region_name, country AS country_name, country AS state_name, country AS city_name, continent,"
    " category_name, subcategory_name, product_name, CAST(order_date AS VARCHAR) AS order_date, order_year,"
    " order_month, quantity, " + doubles("unit_price", "gross_amount", "discount_amount", "unit_cost") + " FROM tx",
    ("tx",),
)
def v_sales_transactions(c: Context):
    return c.mart.transactions_view()


@query(
    "cost_lookup",
    "SELECT category_name, order_year, count(*) AS linhas, count(unit_cost) AS com_custo, "
    + as_double("sum(quantity * unit_cost)", "custo")
    + " FROM tx WHERE transaction_type = 'sale' GROUP BY ALL",
    ("tx",),
)
def cost_lookup(c: Context):
    sold = c.mart.sales_transactions().filter("transaction_type = 'sale'")
    return sold.groupBy("category_name", "order_year").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.count("unit_cost").alias("com_custo"),
        F.sum(F.col("quantity") * F.col("unit_cost")).alias("custo"),
    )


@query("tq_net_sales_total", f"SELECT {as_double(NET, 'net_sales')} FROM tx", ("tx",))
def tq_net_sales_total(c: Context):
    return c.commercial.query({"net_sales": "Net Sales"})


@query(
    "tq_net_sales_by_region",
    f"SELECT region_name AS regiao, {as_double(NET, 'net_sales')} FROM tx GROUP BY 1",
    ("tx",),
)
def tq_net_sales_by_region(c: Context):
    return c.commercial.query({"net_sales": "Net Sales"}, {"regiao": "Regiao"}).orderBy(
        F.desc("net_sales"), "regiao"
    )


@query(
    "tq_net_sales_region_param",
    f"SELECT region_name AS regiao, {as_double(NET, 'net_sales')} FROM tx WHERE region_name = '{REGION}' GROUP BY 1",
    ("tx",),
)
def tq_net_sales_region_param(c: Context):
    return c.commercial.query(
        {"net_sales": "Net Sales"}, {"regiao": "Regiao"}, where=lambda d: d("Regiao") == REGION
    )


@query(
    "tq_top_products",
    f"SELECT product_name AS produto, {as_double(NET, 'net_sales')} FROM tx GROUP BY 1 ORDER BY {NET} DESC, 1 LIMIT 10",
    ("tx",),
)
def tq_top_products(c: Context):
    return (
        c.commercial.query({"net_sales": "Net Sales"}, {"produto": "Produto"})
        .orderBy(F.desc("net_sales"), "produto")
        .limit(10)
    )


@query(
    "tq_margin_by_category",
    f"SELECT category_name AS categoria, {MARGIN_PCT} AS gross_margin_pct, {as_double(NET, 'net_sales')} FROM tx GROUP BY 1",
    ("tx",),
)
def tq_margin_by_category(c: Context):
    return c.commercial.query(
        {"gross_margin_pct": "Gross Margin %", "net_sales": "Net Sales"}, {"categoria": "Categoria"}
    ).orderBy(F.desc("gross_margin_pct"), "categoria")


@query(
    "tq_return_rate",
    f"SELECT region_name AS regiao, {RETURNS_PCT} AS return_rate, {as_double(RETURNS, 'returns_value')}, {as_double(GROSS, 'gross_sales')} FROM tx GROUP BY 1",
    ("tx",),
)
def tq_return_rate(c: Context):
    return c.commercial.query(
        {"return_rate": "% Returns", "returns_value": "Returns", "gross_sales": "Gross Sales"},
        {"regiao": "Regiao"},
    ).orderBy(F.desc("return_rate"), "regiao")


@query(
    "tq_active_customers",
    f"SELECT business_type AS tipo_negocio, {CUSTOMERS} AS clientes_ativos, {as_double(NET, 'net_sales')} FROM tx GROUP BY 1",
    ("tx",),
)
def tq_active_customers(c: Context):
    return c.commercial.query(
        {"clientes_ativos": "Customers Current", "net_sales": "Net Sales"},
        {"tipo_negocio": "TipoNegocio"},
    ).orderBy(F.desc("clientes_ativos"), "tipo_negocio")


@query(
    "active_customers",
    f"SELECT order_year AS ano, region_name AS regiao, {CUSTOMERS} AS clientes_ativos FROM tx GROUP BY 1, 2",
    ("tx",),
)
def active_customers(c: Context):
    return c.commercial.query(
        {"clientes_ativos": "Customers Current"}, {"ano": "Ano", "regiao": "Regiao"}
    )


TI_PCTS = (
    sql_ratio("gross_sales - gross_sales_prev_month", "gross_sales") + " AS mom_pct, "
    + sql_ratio("gross_sales - gross_sales_prev_year", "gross_sales") + " AS yoy_pct"
)


def _growth(c: Context):
    return growth.time_intelligence(c.gold("fct_sales_details"))


@query(
    "time_intelligence",
    "SELECT year, year_month, " + doubles("gross_sales", "gross_sales_prev_month", "gross_sales_prev_year") + f", {TI_PCTS} FROM ti",
    ("ti",),
)
def time_intelligence(c: Context):
    """Through the calendar dimension; the certified questions below take the month from the date."""
    return growth.time_intelligence(c.gold("fct_sales_details"), c.gold("dim_calendar"))


@query("tq_monthly_growth", f"SELECT year_month, {doubles('gross_sales')}, {TI_PCTS} FROM ti", ("ti",))
def tq_monthly_growth(c: Context):
    return _growth(c).select("year_month", "gross_sales", "mom_pct", "yoy_pct").orderBy("year_month")


@query(
    "tq_latest_yoy",
    f"SELECT year_month, {doubles('gross_sales')}, yoy_pct FROM (SELECT year_month, gross_sales, {TI_PCTS} FROM ti)"
    " ORDER BY year_month DESC LIMIT 1",
    ("ti",),
)
def tq_latest_yoy(c: Context):
    return (
        _growth(c).select("year_month", "gross_sales", "yoy_pct").orderBy(F.desc("year_month")).limit(1)
    )


@query(
    "tq_segment_counts",
    f"SELECT segment, count(*) AS qtd_clientes, {as_double('sum(gross_sales_12m)', 'gross_sales_12m')} FROM rfm GROUP BY 1",
    ("rfm",),
)
def tq_segment_counts(c: Context):
    scores = rfm.customer_rfm(c.gold("fct_sales_details"))
    return rfm.segment_counts(scores).orderBy(F.desc("qtd_clientes"), "segment")


@query(
    "tq_customers_by_segment",
    "SELECT DISTINCT customer_name, recency_days, sales_orders_12m, CAST(gross_sales_12m AS DOUBLE) AS gross_sales_12m, segment"
    f" FROM rfm JOIN tx USING (customer_key) WHERE segment = '{SEGMENT}'",
    ("rfm", "tx"),
)
def tq_customers_by_segment(c: Context):
    scores = rfm.customer_rfm(c.gold("fct_sales_details"))
    return rfm.customers_of_segment(
        scores, c.gold("dim_customer"), c.gold("dim_geography"), c.gold("fct_sales_details"), c.gold("dim_product"), SEGMENT
    ).orderBy(
        F.desc("gross_sales_12m"), "customer_name"
    )


@query(
    "tq_avg_price_cost",
    f"SELECT category_name AS categoria, {AVG_PRICE} AS preco_medio, {AVG_COST} AS custo_medio FROM tx GROUP BY 1",
    ("tx",),
)
def tq_avg_price_cost(c: Context):
    return c.commercial.query(
        {"preco_medio": "Avg Unit Price", "custo_medio": "Avg Unit Cost"}, {"categoria": "Categoria"}
    ).orderBy(F.desc("preco_medio"), "categoria")


@query(
    "tq_by_year",
    f"SELECT order_year AS ano, {as_double(NET, 'net_sales')}, {as_double(MARGIN, 'gross_margin')} FROM tx GROUP BY 1",
    ("tx",),
)
def tq_by_year(c: Context):
    return c.commercial.query(
        {"net_sales": "Net Sales", "gross_margin": "Gross Margin"}, {"ano": "Ano"}
    ).orderBy("ano")


BASE_MEASURES = {
    "gross_sales": "Gross Sales", "discounts": "Discounts", "returns": "Returns",
    "net_sales": "Net Sales", "cost_of_sales": "Cost of Sales", "gross_margin": "Gross Margin",
    "quantity": "Quantity",
}
BASE_SQL = ", ".join(
    as_double(e, n)
    for n, e in (
        ("gross_sales", GROSS), ("discounts", DISCOUNTS), ("returns", RETURNS),
        ("net_sales", NET), ("cost_of_sales", COST), ("gross_margin", MARGIN),
    )
)


@query(
    "measures_by_year",
    f"SELECT order_year AS ano, {BASE_SQL}, {QUANTITY} AS quantity FROM tx GROUP BY 1",
    ("tx",),
)
def measures_by_year(c: Context):
    return c.commercial.query(BASE_MEASURES, {"ano": "Ano"}).orderBy("ano")


@query(
    "measures_pct_by_year",
    f"SELECT order_year AS ano, {MARGIN_PCT} AS gm_pct, {NET_MARGIN_PCT} AS nm_pct, {RETURNS_PCT} AS returns_pct FROM tx GROUP BY 1",
    ("tx",),
)
def measures_pct_by_year(c: Context):
    return c.commercial.query(
        {"gm_pct": "Gross Margin %", "nm_pct": "Net Margin %", "returns_pct": "% Returns"},
        {"ano": "Ano"},
    ).orderBy("ano")


@query(
    "measures_composed",
    f"SELECT category_name AS categoria, region_name AS regiao, {BASE_SQL}, {QUANTITY} AS quantity, {CUSTOMERS} AS customers,"
    f" {MARGIN_PCT} AS gm_pct, {NET_MARGIN_PCT} AS nm_pct, {RETURNS_PCT} AS returns_pct,"
    f" {AVG_PRICE} AS avg_price, {AVG_COST} AS avg_cost FROM tx GROUP BY 1, 2",
    ("tx",),
)
def measures_composed(c: Context):
    """All thirteen measures at once."""
    return c.commercial.query(
        BASE_MEASURES
        | {
            "customers": "Customers Current", "gm_pct": "Gross Margin %", "nm_pct": "Net Margin %",
            "returns_pct": "% Returns", "avg_price": "Avg Unit Price", "avg_cost": "Avg Unit Cost",
        },
        {"categoria": "Categoria", "regiao": "Regiao"},
    )


@query(
    "measures_daily",
    f"SELECT CAST(order_date AS VARCHAR) AS data, {as_double(GROSS, 'gross_sales')}, {CUSTOMERS} AS customers FROM tx GROUP BY 1",
    ("tx",),
)
def measures_daily(c: Context):
    return c.commercial.query(
        {"gross_sales": "Gross Sales", "customers": "Customers Current"}, {"data": "Data"}
    )


@query(
    "measures_by_customer",
    "SELECT customer_name AS cliente, country AS pais, country AS cidade, "
    + f"{as_double(NET, 'net_sales')}, {QUANTITY} AS quantity FROM tx GROUP BY ALL",
    ("tx",),
)
def measures_by_customer(c: Context):
    return c.commercial.query(
        {"net_sales": "Net Sales", "quantity": "Quantity"},
        {"cliente": "Cliente", "pais": "Pais", "cidade": "Cidade"},
    )


@query(
    "measures_by_subcategory_month",
    f"SELECT subcategory_name AS subcategoria, order_month AS mes, {as_double(NET, 'net_sales')}, {as_double(COST, 'cost_of_sales')}"
    " FROM tx GROUP BY 1, 2",
    ("tx",),
)
def measures_by_subcategory_month(c: Context):
    return c.commercial.query(
        {"net_sales": "Net Sales", "cost_of_sales": "Cost of Sales"},
        {"subcategoria": "Subcategoria", "mes": "Mes"},
    )


SHOWN = {"vendas": "Gross Sales", "margem": "Gross Margin %", "devolucao": "% Returns", "quantidade": "Quantity"}


@query(
    "format_measures",
    f"""SELECT regiao, '$' || format('{{:,.2f}}', vendas) AS vendas, format('{{:.1f}}', margem * 100) || '%' AS margem,
          format('{{:.1f}}', devolucao * 100) || '%' AS devolucao, format('{{:,}}', quantidade) AS quantidade
        FROM (SELECT region_name AS regiao, {as_double(GROSS, 'vendas')}, {MARGIN_PCT} AS margem,
                {RETURNS_PCT} AS devolucao, {QUANTITY} AS quantidade FROM tx GROUP BY 1)""",
    ("tx",),
)
def format_measures(c: Context):
    return c.commercial.formatted(c.commercial.query(SHOWN, {"regiao": "Regiao"}), SHOWN)


@query(
    "named_parameters",
    f"SELECT region_name, order_year, count(*) AS linhas, {as_double(GROSS, 'gross_sales')} FROM tx"
    f" WHERE region_name = '{REGION}' AND order_year >= 1998 GROUP BY 1, 2",
    ("tx",),
)
def named_parameters(c: Context):
    """The views queried in plain SQL with named parameters."""
    c.mart.register_views(c.spark)
    return c.spark.sql(
        """SELECT region_name, order_year, count(*) AS linhas,
                  sum(gross_amount) FILTER (WHERE transaction_type = 'sale') AS gross_sales
           FROM v_sales_transactions WHERE region_name = :regiao AND order_year >= :ano
           GROUP BY region_name, order_year""",
        args={"regiao": REGION, "ano": 1998},
    )
