"""Finance metric view, vertical and horizontal analysis of the income statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.numbers import or_zero, ratio
from martloom.plans.mart import Mart
from martloom.plans.metrics import Dimension, Measure, MetricView

# Fixed value: the income-statement header every line is compared to.
NET_SALES_HEADER = 3


def _scenario(kind: str) -> Column:
    return F.when(F.col("scenario") == kind, F.col("signed_amount"))


# Names, labels and synonyms users ask by.
DIMENSIONS = (
    Dimension("Data", "transaction_date"),
    Dimension("Ano", "year"),
    Dimension("Trimestre", "quarter"),
    Dimension("Mes", "month_name", "Mês", ("mes",)),
    Dimension("LinhaDRE", "account_header_name", "Linha da DRE", ("linha dre", "grupo de conta")),
    Dimension("Conta", "account_name", None, ("account", "conta contábil")),
    Dimension("SubConta", "account_subheader", "Subconta", ("subheader", "subconta")),
    Dimension("TipoConta", "account_type", "Tipo de Conta"),
    Dimension("Organizacao", "organization_name", "Organização", ("organization", "unidade")),
    Dimension("OrganizacaoPai", "parent_organization", "Organização Pai"),
    Dimension(
        "DepartmentGroup", "department_group_name", "Grupo de Departamentos",
        ("departamento", "department"),
    ),
    Dimension("Cenario", "scenario", "Cenário", ("scenario", "realizado", "orçado")),
)

MEASURES = (
    Measure(
        "Total Amount Actual",
        base=lambda: F.sum(_scenario("actual")),
        label="Realizado",
        synonyms=("realizado", "actual"),
    ),
    Measure(
        "Total Amount Budget",
        base=lambda: F.sum(_scenario("budget")),
        label="Orçado",
        synonyms=("orçado", "budget"),
    ),
    Measure(
        "Budget Deviation",
        derived=lambda m: or_zero(m("Total Amount Actual")) - or_zero(m("Total Amount Budget")),
        uses=("Total Amount Actual", "Total Amount Budget"),
        label="Desvio Orçamentário",
        synonyms=("desvio", "variação orçamentária"),
    ),
    Measure(
        "Budget Deviation %",
        derived=lambda m: ratio(m("Budget Deviation"), F.abs(m("Total Amount Budget"))),
        uses=("Budget Deviation", "Total Amount Budget"),
        kind="percentage",
        label="Desvio Orçamentário %",
        synonyms=("desvio percentual",),
    ),
)


def finance_view(mart: Mart) -> MetricView:
    return MetricView("finance", lambda _: mart.income_statement(), DIMENSIONS, MEASURES)


def vertical_analysis(statement: DataFrame, *by: str) -> DataFrame:
    """Actual amount per group and its share of actual net sales (header 3), one pass.

    Both sums come from the same aggregation: the share's base is the per-group amount that
    belongs to the net-sales header, summed over the (few) groups afterwards.
    """
    is_base = F.col("account_header_key") == NET_SALES_HEADER
    per_group = (
        statement.filter("scenario = 'actual'")
        .groupBy(*by)
        .agg(
            F.sum("signed_amount").alias("valor"),
            F.sum(F.when(is_base, F.col("signed_amount"))).alias("_base"),
        )
    )
    base = F.sum("_base").over(Window.partitionBy())
    return per_group.select(*by, "valor", ratio(F.col("valor"), base).alias("va_pct"))


def horizontal_analysis(statement: DataFrame) -> DataFrame:
    """Actual amount per line and month with its change against the line's previous month."""
    monthly = (
        statement.filter("scenario = 'actual'")
        .groupBy("account_header_name", (F.col("year") * 100 + F.col("month")).alias("year_month"))
        .agg(F.sum("signed_amount").alias("valor"))
    )
    line = Window.partitionBy("account_header_name").orderBy("year_month")
    return monthly.withColumn("valor_anterior", F.lag("valor").over(line)).withColumn(
        "ha_pct", ratio(F.col("valor") - F.col("valor_anterior"), F.abs(F.col("valor_anterior")))
    )


def statement_subtotals(statement: DataFrame) -> DataFrame:
    """Actual and budget with subtotals per header, subheader and account."""
    levels = ["account_header_name", "account_subheader", "account_name"]
    return (
        statement.rollup(*levels)
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.sum(_scenario("actual")).alias("realizado"),
            F.sum(_scenario("budget")).alias("orcado"),
        )
        .select(*levels, "level", "realizado", "orcado")
    )
