"""Release checks, access policy, usage cost, publication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators import checks, policy
from martloom.operators.quality import enforce
from martloom.plans import usage
from martloom.plans.commercial import commercial_view
from martloom.plans.contracts import CONTRACTS, contract_profile
from martloom.plans.mart import Mart
from martloom.plans.refresh import analytic_tables
from martloom.plans.silver import SPECS
from martloom.registry.core import QUERIES, Context, query
from martloom.registry.oracle import GROSS, NET, RETURNS, as_double
from martloom.session import scratch_dir
from martloom.sinks.lake import Lake
from martloom.sinks.relational import ANALYTIC_TABLES, MANIFEST, LakeTarget, publish, reconcile, reconcile_content

def _grain_sql(table: str, relation: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_keys,"
        f" count(*) FILTER (WHERE n > 1) AS duplicated_keys FROM (SELECT count(*) AS n FROM {relation} GROUP BY {key})"
    )


@query(
    "grain_check",
    "SELECT l_orderkey * 10 + l_linenumber AS sales_details_key, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def grain_check(c: Context):
    return checks.grain_violations(c.gold("fct_sales_details"), ["sales_details_key"])


def _gold_sql(table: str) -> str:
    """The checking SQL of a gold or analytic table's own query."""
    named = {"fct_product_cost_history": "fct_cost_history", "forecast_sales": "serve_forecast", "reco_customer_actions": "reco_actions"}
    return QUERIES[named.get(table, table)].sql


@query(
    "grain_summary",
    " UNION ALL ".join(_grain_sql(m.source, f"({_gold_sql(m.source)})", ", ".join(m.primary_key)) for m in MANIFEST),
)
def grain_summary(c: Context):
    """The primary keys of all sixteen published tables."""
    analytic = analytic_tables(c.mart)
    return checks.grain_summary(
        (m.source, analytic[m.source] if m.source in analytic else c.gold(m.source), m.primary_key) for m in MANIFEST
    )


@query(
    "calendar_grain",
    "SELECT 'dim_calendar' AS table_name, count(*) AS total_rows, count(DISTINCT full_date) AS distinct_keys,"
    f" count(*) - count(DISTINCT full_date) AS duplicated_keys FROM ({QUERIES['dim_calendar'].sql})",
)
def calendar_grain(c: Context):
    return checks.grain_summary([("dim_calendar", c.gold("dim_calendar"), ["full_date"])])


@query(
    "reconcile_totals",
    """SELECT gold AS left_total, semantic AS right_total, gold - semantic AS difference
       FROM (SELECT CAST((SELECT sum(gross_sales) FROM fct) AS DOUBLE) AS gold,
               CAST((SELECT sum(gross_amount) FROM tx WHERE transaction_type = 'sale') AS DOUBLE) AS semantic)""",
    ("fct", "tx"),
)
def reconcile_totals(c: Context):
    """Line amounts against quantity times price: they differ by the rounding of the price."""
    sold = c.mart.sales_transactions(with_cost=False).filter("transaction_type = 'sale'")
    return checks.side_by_side(
        F.sum("gross_sales").cast("double"), c.gold("fct_sales_details"),
        F.sum("gross_amount").cast("double"), sold,
    )


@query(
    "reconcile_ledger",
    """SELECT gold AS left_total, semantic AS right_total, gold - semantic AS difference
       FROM (SELECT (SELECT count(*) FROM ledger) AS gold, (SELECT count(*) FROM stmt) AS semantic)""",
    ("ledger", "stmt"),
)
def reconcile_ledger(c: Context):
    """Entries before and after the five inner joins of the income statement."""
    rows = F.count(F.lit(1))
    statement = c.mart.income_statement(join_calendar=True)
    return checks.side_by_side(rows, c.gold("fct_finance"), rows, statement)


@query(
    "null_cost_share",
    """SELECT count(*) AS linhas_venda, count(*) - count(unit_cost) AS sem_custo,
         round((count(*) - count(unit_cost)) * 100.0 / nullif(count(*), 0), 1) AS pct_sem_custo
       FROM tx WHERE transaction_type = 'sale'""",
    ("tx",),
)
def null_cost_share(c: Context):
    return checks.null_share(
        c.mart.sales_transactions().filter("transaction_type = 'sale'"), "unit_cost"
    )


@query(
    "smoke_by_type",
    f"SELECT transaction_type, count(*) AS linhas, {as_double('sum(gross_amount)', 'bruto')} FROM tx GROUP BY 1",
    ("tx",),
)
def smoke_by_type(c: Context):
    return c.mart.sales_transactions(with_cost=False).groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("linhas"), F.sum("gross_amount").alias("bruto")
    )


@query("smoke_by_scenario", "SELECT scenario, count(*) AS linhas FROM stmt GROUP BY 1", ("stmt",))
def smoke_by_scenario(c: Context):
    return checks.count_by(c.mart.income_statement(), "scenario")


# Per fact or dimension: the keys it holds, and the table and column each must be found in.
REFERENCES = {
    "fct_sales_details": (("dim_customer", "customer_key"), ("dim_product", "product_key"), ("dim_region", "region_key")),
    "fct_sales_returns": (("dim_customer", "customer_key"), ("dim_product", "product_key")),
    "fct_finance": (
        ("dim_account", "account_key"), ("dim_organization", "organization_key"),
        ("dim_department_group", "department_group_key"), ("dim_calendar", "transaction_date"),
    ),
    "fct_product_cost_history": (("dim_product", "product_key"),),
    "dim_customer": (("dim_geography", "geography_key"),),
    "dim_geography": (("dim_region", "region_key"),),
    "dim_account": (("dim_account_header", "account_header_key"),),
}
_KNOWN_AS = {"transaction_date": "full_date"}


def _orphan_sql(fact: str, dimension: str, key: str) -> str:
    known = _KNOWN_AS.get(key, key)
    source = "SELECT c_custkey AS customer_key FROM customer WHERE c_acctbal >= 0" if dimension == "dim_customer" else _gold_sql(dimension)
    return (
        f"SELECT '{fact}' AS fact, '{dimension}' AS dimension, count(*) AS orphan_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS orphan_rows"
        f" FROM (SELECT {key} AS k, count(*) AS n FROM ({_gold_sql(fact)}) GROUP BY 1)"
        f" WHERE k IS NULL OR k NOT IN (SELECT {known} FROM ({source}) WHERE {known} IS NOT NULL)"
    )


@query("orphan_audit", " UNION ALL ".join(_orphan_sql(f, d, k) for f, refs in REFERENCES.items() for d, k in refs))
def orphan_audit(c: Context):
    """Every reference of the star. Customers whom the revenue rule drops leave orphans behind."""
    dimensions = {"dim_customer": enforce(c.gold("dim_customer"), SPECS["customer"].rules)}
    parts = []
    for fact, refs in REFERENCES.items():
        known = [
            (d, (dimensions.get(d) or c.gold(d)).select(F.col(_KNOWN_AS.get(k, k)).alias(k)), k) for d, k in refs
        ]
        parts.append(checks.orphan_audit(c.gold(fact), known).withColumn("fact", F.lit(fact)))
    return reduce(DataFrame.unionByName, parts).select("fact", "dimension", "orphan_keys", "orphan_rows")


# Access grants: one region, two regions; anyone else sees nothing.
GRANTS = (("a@x", "AFRICA"), ("b@x", "ASIA"), ("b@x", "EUROPE"))
PRINCIPAL = "b@x"


def _grants(c: Context) -> DataFrame:
    return c.spark.createDataFrame(GRANTS, policy.GRANTS_SCHEMA)


def _seen_by(c: Context, principal: str, is_admin: bool = False) -> Mart:
    return policy.restricted(c.mart, _grants(c), principal, is_admin)


VISIBLE_SQL = (
    f"SELECT region_name AS regiao, {as_double(GROSS, 'gross_sales')}, {as_double(RETURNS, 'returns')},"
    f" {as_double(NET, 'net_sales')} FROM tx"
)


def _visible_sales(mart: Mart) -> DataFrame:
    return commercial_view(mart).query(
        {"gross_sales": "Gross Sales", "returns": "Returns", "net_sales": "Net Sales"}, {"regiao": "Regiao"}
    )


@query("rls_filter", f"{VISIBLE_SQL} WHERE region_name IN ('ASIA', 'EUROPE') GROUP BY 1", ("tx",))
def rls_filter(c: Context):
    return _visible_sales(_seen_by(c, PRINCIPAL))


@query("rls_admin", f"{VISIBLE_SQL} GROUP BY 1", ("tx",))
def rls_admin(c: Context):
    return _visible_sales(_seen_by(c, "admin@x", is_admin=True))


@query("rls_unmapped", f"{VISIBLE_SQL} WHERE region_name = '' GROUP BY 1", ("tx",))
def rls_unmapped(c: Context):
    return _visible_sales(_seen_by(c, "nobody@x"))


@query(
    "rls_function",
    "SELECT CAST(geography_key AS BIGINT) AS geography_key, region_name FROM place WHERE region_name IN ('ASIA', 'EUROPE')",
    ("place",),
)
def rls_function(c: Context):
    policy.register_policy_functions(c.spark, _grants(c), PRINCIPAL, is_admin=False)
    c.gold("dim_geography").createOrReplaceTempView("places_to_filter")
    return c.spark.sql(
        "SELECT geography_key, region_name FROM places_to_filter WHERE rls_region(region_name)"
    )


@query(
    "mask_column",
    "SELECT c_custkey AS customer_key, c_name AS customer_name, CAST(NULL AS DOUBLE) AS annual_revenue FROM customer",
)
def mask_column(c: Context):
    return _seen_by(c, PRINCIPAL).gold("dim_customer").select("customer_key", "customer_name", "annual_revenue")


@query(
    "mask_admin",
    "SELECT c_custkey AS customer_key, c_name AS customer_name, c_acctbal AS annual_revenue FROM customer",
)
def mask_admin(c: Context):
    seen = _seen_by(c, "admin@x", is_admin=True)
    return seen.gold("dim_customer").select("customer_key", "customer_name", "annual_revenue")


def _contract_sql(tables: tuple[str, ...]) -> str:
    parts = []
    for table in tables:
        contract = CONTRACTS[table]
        rows = []
        for column in contract.columns:
            comment = column.comment.replace("'", "''")
            domain = f"'{contract.domain}'" if contract.domain else "CAST(NULL AS VARCHAR)"
            key = str(column.name in contract.primary_key).lower()
            rows.append(
                f"SELECT '{table}' AS table_name, '{column.name}' AS column_name, '{column.type}' AS column_type,"
                f" '{comment}' AS comment, {domain} AS domain, {key} AS in_primary_key,"
                f" count(*) AS total_rows, count({column.name}) AS filled_rows FROM t"
            )
        parts.append(f"SELECT * FROM (WITH t AS ({_gold_sql(table)}) {' UNION ALL '.join(rows)})")
    return " UNION ALL ".join(parts)


# The four facts as they are promised, written out apart from the contracts.
PROMISED = {
    "fct_sales_details": """sales_details_key bigint, sales_header_key bigint, customer_key bigint, product_key bigint,
        region_key bigint, order_date date, due_date date, ship_date date, sales_order_number string, order_quantity int,
        unit_price decimal(18;4), gross_sales decimal(18;4), discount_allocated decimal(18;4), net_sales decimal(18;4),
        lead_time_days int, promised_lead_time_days int, delivery_delay_days int, is_late boolean""",
    "fct_sales_returns": """return_key bigint, customer_key bigint, product_key bigint, return_date date, order_date date,
        sales_order_number string, return_quantity int, unit_price decimal(18;4), return_amount decimal(18;4)""",
    "fct_finance": """finance_key bigint, account_key bigint, organization_key bigint, department_group_key bigint,
        transaction_date date, scenario string, amount decimal(18;4)""",
    "fct_product_cost_history": "product_key bigint, year int, month_no int, country_code string, unit_cost decimal(18;4)",
}


def _promised_sql() -> str:
    parts = []
    for table, columns in PROMISED.items():
        rows = [
            f"SELECT '{table}' AS table_name, {i} AS position, '{name}' AS column_name, '{kind.replace(';', ',')}' AS column_type,"
            f" count({name}) AS filled_rows FROM t"
            for i, (name, kind) in enumerate(column.split() for column in columns.split(","))
        ]
        parts.append(f"SELECT * FROM (WITH t AS ({_gold_sql(table)}) {' UNION ALL '.join(rows)})")
    return " UNION ALL ".join(parts)


@query("schema_contract", _promised_sql())
def schema_contract(c: Context):
    """Columns, order and types of the facts as they come out, before anything is made plain for comparison."""
    parts = []
    for table in PROMISED:
        df = c.gold(table)
        counts = df.agg(*[F.count(name).alias(name) for name in df.columns])
        rows = [
            F.struct(
                F.lit(table).alias("table_name"), F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"), F.col(f.name).alias("filled_rows"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


@query("domain_registry", _contract_sql(tuple(CONTRACTS)))
def domain_registry(c: Context):
    """Declared columns and filled rows of every gold table, with the domain that may see it."""
    return contract_profile((contract, c.gold(t)) for t, contract in CONTRACTS.items())


AS_OF = "2024-02-10"
# List prices per event type, changing once.
PRICE_CHANGE = "2024-01-15 00:00:00"
PRICES = (
    ("click", "0.0100", "0.0120"), ("error", "0.0500", "0.0450"), ("purchase", "0.2000", "0.2500"),
    ("signup", "0.1000", "0.1100"), ("view", "0.0020", "0.0025"),
)


def _usage(c: Context) -> DataFrame:
    return c.sample.read("events").select(
        F.col("event_type").alias("sku_name"),
        F.concat(F.lit("product "), F.col("event_type")).alias("billing_origin_product"),
        F.col("value").cast("decimal(18,2)").alias("usage_quantity"),
        F.col("ts").alias("usage_start_time"),
        (F.col("ts") + F.expr("interval 1 hour")).alias("usage_end_time"),
        F.col("ts").cast("date").alias("usage_date"),
        F.from_json("props", "map<string,string>").alias("custom_tags"),
    )


def _prices(c: Context) -> DataFrame:
    rows = [
        row
        for sku, before, after in PRICES
        for row in ((sku, "2023-01-01 00:00:00", PRICE_CHANGE, before), (sku, PRICE_CHANGE, None, after))
    ]
    stamp = lambda name: F.col(name).cast("timestamp_ntz").alias(name)
    return c.spark.createDataFrame(
        rows, "sku_name string, price_start_time string, price_end_time string, price string"
    ).select(
        "sku_name", stamp("price_start_time"), stamp("price_end_time"),
        F.struct(F.col("price").cast("decimal(18,4)").alias("default")).alias("pricing"),
    )


def _as_of():
    return F.lit(AS_OF).cast("date")


SINCE_SQL = f"DATE '{AS_OF}' - 30"
COST_SQL = f""", price AS (
      SELECT sku, TIMESTAMP '2023-01-01 00:00:00' AS p_from, TIMESTAMP '{PRICE_CHANGE}' AS p_to, CAST(old AS DECIMAL(18,4)) AS unit
      FROM (VALUES {", ".join(str(p) for p in PRICES)}) v(sku, old, new)
      UNION ALL SELECT sku, TIMESTAMP '{PRICE_CHANGE}', NULL, CAST(new AS DECIMAL(18,4)) FROM (VALUES {", ".join(str(p) for p in PRICES)}) v(sku, old, new))
    SELECT billing_origin_product, CAST(round(sum(usage_quantity * unit), 2) AS DOUBLE) AS custo_usd
    FROM bill JOIN price ON sku = sku_name AND usage_start_time >= p_from AND (usage_end_time <= p_to OR p_to IS NULL)
    WHERE usage_date >= {SINCE_SQL} GROUP BY 1"""


@query("usage_cost", COST_SQL, ("bill",))
def usage_cost(c: Context):
    return usage.cost_by_product(_usage(c), _prices(c), _as_of()).orderBy(F.desc("custo_usd"))


@query("usage_cost_bucketed", COST_SQL, ("bill",))
def usage_cost_bucketed(c: Context):
    return usage.cost_by_product(_usage(c), _prices(c), _as_of(), bucket_days=7)


@query("usage_cost_aligned", COST_SQL, ("bill",))
def usage_cost_aligned(c: Context):
    """The same costs by one sort of usage and prices, without range conditions."""
    return usage.aligned_cost_by_product(_usage(c), _prices(c), _as_of(), salts=4)


@query(
    "usage_by_tag",
    f"SELECT tag AS dominio, CAST(round(sum(usage_quantity), 4) AS DOUBLE) AS qtd FROM bill WHERE usage_date >= {SINCE_SQL} GROUP BY 1",
    ("bill",),
)
def usage_by_tag(c: Context):
    return usage.usage_by_tag(_usage(c), "k", _as_of())


def _query_history(c: Context) -> DataFrame:
    return c.sample.read("events").select(
        F.col("ts").alias("start_time"),
        F.col("user_id").alias("executed_by"),
        (F.col("value").cast("decimal(18,2)") * 1000).alias("total_duration_ms"),
    )


@query(
    "events_per_day",
    f"SELECT CAST(usage_date AS VARCHAR) AS dia, count(*) AS queries FROM bill WHERE usage_date >= {SINCE_SQL} GROUP BY 1",
    ("bill",),
)
def events_per_day(c: Context):
    return usage.queries_per_day(_query_history(c), _as_of()).orderBy("dia")


@query(
    "query_latency",
    f"""SELECT user_id AS executed_by, count(*) AS queries,
          round(CAST(sum(usage_quantity * 1000) AS DOUBLE) / count(*) / 1000, 1) AS media_seg
        FROM bill WHERE usage_date >= {SINCE_SQL} GROUP BY 1""",
    ("bill",),
)
def query_latency(c: Context):
    return usage.latency_by_user(_query_history(c), _as_of()).orderBy(F.desc("queries"), "executed_by")


#: Gold tables with a key that is unique in the sample; its order lines repeat theirs.
CONTENT_CHECKED = tuple(t for t in CONTRACTS if t not in ("fct_sales_details", "fct_sales_returns"))


def _publish_all(c: Context, target: LakeTarget) -> dict[str, int]:
    """Gold first, each table composed once; the analytic tables read the gold just published."""
    analytic_names = {m.source for m in ANALYTIC_TABLES}
    written = publish(c.gold, target, [m for m in MANIFEST if m.source not in analytic_names])
    analytic = analytic_tables(c.mart.over(lambda t: target.read(f"gold.{t}")))
    return written | publish(analytic.__getitem__, target, ANALYTIC_TABLES)


def _manifest_sql(row: str) -> str:
    return " UNION ALL ".join(row.format(m=m, key=", ".join(m.primary_key), sql=_gold_sql(m.source)) for m in MANIFEST)


@query(
    "export_manifest",
    _manifest_sql("SELECT '{m.source}' AS source, '{m.destination}' AS destination, '{key}' AS primary_key, count(*) AS target_rows FROM ({sql})"),
)
def export_manifest(c: Context):
    """All sixteen tables published as folders, then counted where they landed."""
    target = LakeTarget(Lake(c.spark, scratch_dir(c.spark, "publish")))
    _publish_all(c, target)
    parts = None
    for entry in MANIFEST:
        part = target.read(entry.destination).agg(F.count(F.lit(1)).alias("target_rows")).select(
            F.lit(entry.source).alias("source"),
            F.lit(entry.destination).alias("destination"),
            F.lit(", ".join(entry.primary_key)).alias("primary_key"),
            "target_rows",
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


@query(
    "export_reconcile",
    _manifest_sql("SELECT '{m.destination}' AS table_name, count(*) AS source_rows, count(*) AS target_rows, 'OK' AS status FROM ({sql})"),
)
def export_reconcile(c: Context):
    """All sixteen tables: rows counted as they were written against rows found afterwards."""
    target = LakeTarget(Lake(c.spark, scratch_dir(c.spark, "reconcile")))
    return reconcile(c.spark, _publish_all(c, target), target)


@query(
    "export_content",
    "SELECT 'gold.fct_finance' AS table_name, '{\"finance_key\":' || max(o_orderkey) || '}' AS key, 'changed' AS kind, CAST(1 AS BIGINT) AS source_rows,"
    " CAST(1 AS BIGINT) AS target_rows FROM orders WHERE o_orderstatus IN ('F', 'O')"
    " UNION ALL SELECT 'gold.dim_customer', '{\"customer_key\":' || max(c_custkey) || '}', 'missing', 1, 0 FROM customer"
    " UNION ALL SELECT 'gold.dim_region', '{\"region_key\":99}', 'extra', 0, 1",
)
def export_content(c: Context):
    """Gold is published, then a cent, a row and a stranger are slipped into the target; comparing content names all three."""
    lake = Lake(c.spark, scratch_dir(c.spark, "content"))
    target, entries = LakeTarget(lake), [m for m in MANIFEST if m.source in CONTENT_CHECKED]
    publish(c.gold, target, entries)
    ledger, customers, regions = (lake.read("gold", t) for t in ("fct_finance", "dim_customer", "dim_region"))
    newest = ledger.agg(F.max("finance_key")).scalar()
    cent = F.when(F.col("finance_key") == newest, F.lit("0.01").cast("decimal(18,4)")).otherwise(F.lit(0).cast("decimal(18,4)"))
    lake.replace(ledger.withColumn("amount", (F.col("amount") + cent).cast("decimal(18,4)")), "gold", "fct_finance")
    lake.replace(customers.filter(F.col("customer_key") < customers.agg(F.max("customer_key")).scalar()), "gold", "dim_customer")
    lake.replace(regions.unionByName(regions.limit(1).withColumn("region_key", F.lit(99).cast("long"))), "gold", "dim_region")
    return reconcile_content(c.gold, target, entries)


DOMAIN_TABLES = {
    "comercial": "dim_calendar dim_customer dim_geography dim_product dim_region fct_product_cost_history fct_sales_details fct_sales_returns",
    "financeiro": "dim_account dim_account_header dim_calendar dim_department_group dim_geography dim_organization dim_region fct_finance"
    " fct_product_cost_history",
}


@query(
    "domain_separation",
    " UNION ALL ".join(
        f"SELECT '{domain}' AS domain, '{t}' AS table_name, {str(t in tables.split()).lower()} AS open, count(*) AS total_rows FROM ({_gold_sql(t)})"
        for domain, tables in DOMAIN_TABLES.items() for t in CONTRACTS
    ),
)
def domain_separation(c: Context):
    """Which gold tables a mart limited to a domain hands out."""
    parts = []
    for domain in DOMAIN_TABLES:
        limited = c.mart.for_domain(domain)
        for table in CONTRACTS:
            try:
                df, is_open = limited.gold(table), True
            except PermissionError:
                df, is_open = c.gold(table), False
            parts.append(df.agg(F.count(F.lit(1)).alias("total_rows")).select(
                F.lit(domain).alias("domain"), F.lit(table).alias("table_name"), F.lit(is_open).alias("open"), "total_rows"
            ))
    return reduce(DataFrame.unionByName, parts)
