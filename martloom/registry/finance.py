"""Finance metric view: certified questions and statement analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from martloom.plans import finance
from martloom.registry.core import Context, query
from martloom.registry.oracle import ACTUAL, BUDGET, DEVIATION, as_double, doubles, sql_ratio

YEAR = 1998
AMOUNTS = {"realizado": "Total Amount Actual", "orcado": "Total Amount Budget"}
AMOUNTS_SQL = f"{as_double(ACTUAL, 'realizado')}, {as_double(BUDGET, 'orcado')}"
DEVIATION_SQL = as_double(DEVIATION, "desvio")
DEVIATION_PCT = sql_ratio(DEVIATION, f"abs({BUDGET})")


@query(
    "v_income_statement",
    "SELECT finance_key, scenario, account_key, account_name, account_type, account_subheader, account_header_key,"
    " account_header_name, header_detail, organization_name, parent_organization, department_group_name,"
    " CAST(transaction_date AS VARCHAR) AS transaction_date, year, quarter, month, month_name, sign, "
    + doubles("amount", "signed_amount") + " FROM stmt",
    ("stmt",),
)
def v_income_statement(c: Context):
    """All five dimensions joined, the calendar among them."""
    return c.mart.income_statement(join_calendar=True)


@query("tq_actual_budget", f"SELECT {AMOUNTS_SQL} FROM stmt", ("stmt",))
def tq_actual_budget(c: Context):
    return c.finance.query(AMOUNTS)


@query(
    "tq_dre_lines",
    f"SELECT account_header_name AS linha_dre, {AMOUNTS_SQL}, {DEVIATION_SQL}, {DEVIATION_PCT} AS desvio_pct FROM stmt GROUP BY 1",
    ("stmt",),
)
def tq_dre_lines(c: Context):
    return c.finance.query(
        AMOUNTS | {"desvio": "Budget Deviation", "desvio_pct": "Budget Deviation %"},
        {"linha_dre": "LinhaDRE"},
    ).orderBy("desvio", "linha_dre")


@query(
    "tq_top_deviation",
    f"SELECT account_name AS conta, {AMOUNTS_SQL}, {DEVIATION_SQL} FROM stmt GROUP BY 1 ORDER BY abs({DEVIATION}) DESC, 1 LIMIT 10",
    ("stmt",),
)
def tq_top_deviation(c: Context):
    return (
        c.finance.query(AMOUNTS | {"desvio": "Budget Deviation"}, {"conta": "Conta"})
        .orderBy(F.abs("desvio").desc(), "conta")
        .limit(10)
    )


@query(
    "tq_actual_monthly",
    f"SELECT year AS ano, month_name AS mes, {as_double(ACTUAL, 'realizado')} FROM stmt GROUP BY 1, 2",
    ("stmt",),
)
def tq_actual_monthly(c: Context):
    return c.finance.query(
        {"realizado": "Total Amount Actual"}, {"ano": "Ano", "mes": "Mes"}
    ).orderBy("ano", "mes")


@query(
    "tq_actual_year_param",
    f"SELECT year AS ano, {AMOUNTS_SQL}, {DEVIATION_SQL} FROM stmt WHERE year = {YEAR} GROUP BY 1",
    ("stmt",),
)
def tq_actual_year_param(c: Context):
    return c.finance.query(
        AMOUNTS | {"desvio": "Budget Deviation"}, {"ano": "Ano"}, where=lambda d: d("Ano") == YEAR
    )


@query(
    "tq_actual_by_org",
    f"SELECT organization_name AS organizacao, {as_double(ACTUAL, 'realizado')} FROM stmt GROUP BY 1",
    ("stmt",),
)
def tq_actual_by_org(c: Context):
    return c.finance.query(
        {"realizado": "Total Amount Actual"}, {"organizacao": "Organizacao"}
    ).orderBy(F.desc("realizado"), "organizacao")


@query(
    "measures_finance",
    f"SELECT quarter AS trimestre, account_subheader AS subconta, account_type AS tipo, parent_organization AS divisao,"
    f" department_group_name AS departamento, {AMOUNTS_SQL}, {DEVIATION_SQL}, {DEVIATION_PCT} AS desvio_pct FROM stmt GROUP BY ALL",
    ("stmt",),
)
def measures_finance(c: Context):
    """All four measures over the remaining dimensions."""
    return c.finance.query(
        AMOUNTS | {"desvio": "Budget Deviation", "desvio_pct": "Budget Deviation %"},
        {
            "trimestre": "Trimestre", "subconta": "SubConta", "tipo": "TipoConta",
            "divisao": "OrganizacaoPai", "departamento": "DepartmentGroup",
        },
    )


VA_BASE = "(SELECT sum(signed_amount) FROM stmt WHERE scenario = 'actual' AND account_header_key = 3)"


@query(
    "va_pct_line",
    f"SELECT account_header_name AS linha_dre, {as_double('sum(signed_amount)', 'valor')},"
    f" {sql_ratio('sum(signed_amount)', VA_BASE)} AS va_pct FROM stmt WHERE scenario = 'actual' GROUP BY 1",
    ("stmt",),
)
def va_pct_line(c: Context):
    return (
        finance.vertical_analysis(c.mart.income_statement(), "account_header_name")
        .withColumnRenamed("account_header_name", "linha_dre")
        .orderBy(F.desc("va_pct"), "linha_dre")
    )


@query(
    "va_pct_account",
    f"SELECT account_header_name AS linha_dre, account_name AS conta, {as_double('sum(signed_amount)', 'valor')},"
    f" {sql_ratio('sum(signed_amount)', VA_BASE)} AS va_pct FROM stmt WHERE scenario = 'actual' GROUP BY 1, 2",
    ("stmt",),
)
def va_pct_account(c: Context):
    return (
        finance.vertical_analysis(c.mart.income_statement(), "account_header_name", "account_name")
        .withColumnsRenamed({"account_header_name": "linha_dre", "account_name": "conta"})
        .orderBy(F.desc("va_pct"), "linha_dre", "conta")
    )


@query(
    "ha_pct",
    f"""SELECT account_header_name, year_month, {doubles('valor', 'valor_anterior')},
         {sql_ratio('valor - valor_anterior', 'abs(valor_anterior)')} AS ha_pct
       FROM (SELECT *, lag(valor) OVER (PARTITION BY account_header_name ORDER BY year_month) AS valor_anterior
             FROM (SELECT account_header_name, CAST(year * 100 + month AS INTEGER) AS year_month,
                     sum(signed_amount) AS valor
                   FROM stmt WHERE scenario = 'actual' GROUP BY 1, 2))""",
    ("stmt",),
)
def ha_pct(c: Context):
    return finance.horizontal_analysis(c.mart.income_statement())


@query(
    "dre_subtotals",
    "SELECT account_header_name, account_subheader, account_name,"
    f" CAST(grouping(account_header_name) * 4 + grouping(account_subheader) * 2 + grouping(account_name) AS INTEGER) AS level, {AMOUNTS_SQL}"
    " FROM stmt GROUP BY ROLLUP (account_header_name, account_subheader, account_name)",
    ("stmt",),
)
def dre_subtotals(c: Context):
    return finance.statement_subtotals(c.mart.income_statement())
