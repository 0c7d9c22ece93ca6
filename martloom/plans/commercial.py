"""Commercial metric view: thirteen sales, return and margin measures."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.numbers import exact_avg, or_zero, ratio
from martloom.plans.mart import Mart
from martloom.plans.metrics import Dimension, Measure, MetricView


def _sum(column: Callable[[], Column], name: str) -> dict[str, object]:
    """A measure that is one sum: its base, its only part, and the sum of the parts."""
    return {
        "base": lambda: F.sum(column()), "parts": {name: lambda: F.sum(column())}, "whole": lambda part: F.sum(part(name)),
    }


def _average(column: Callable[[], Column], name: str) -> dict[str, object]:
    """An exact average, from a sum and a count."""
    total, n = f"{name}_sum", f"{name}_count"
    return {
        "base": lambda: exact_avg(column()),
        "parts": {total: lambda: F.sum(column()), n: lambda: F.count(column())},
        "whole": lambda part: ratio(F.sum(part(total)), F.sum(part(n))),
    }


def _on(kind: str, column: str) -> Column:
    return F.when(F.col("transaction_type") == kind, F.col(column))


# Names, labels and synonyms users ask by.
DIMENSIONS = (
    Dimension("Data", "order_date"),
    Dimension("Ano", "order_year"),
    Dimension("Mes", "order_month"),
    Dimension("Cliente", "customer_name", None, ("customer", "conta")),
    Dimension("TipoNegocio", "business_type", "Tipo de Negócio", ("business type", "segmento")),
    Dimension("Regiao", "region_name", "Região", ("region",)),
    Dimension("Pais", "country_name", "País", ("country", "pais")),
    Dimension("Cidade", "city_name", None, ("city",)),
    Dimension("Categoria", "category_name", None, ("category",)),
    Dimension("Subcategoria", "subcategory_name", None, ("subcategory",)),
    Dimension("Produto", "product_name", None, ("product", "produto")),
)

MEASURES = (
    Measure(
        "Gross Sales",
        **_sum(lambda: _on("sale", "gross_amount"), "gross_sales"),
        label="Vendas Brutas",
        synonyms=("vendas brutas", "revenue bruto"),
    ),
    Measure(
        "Returns",
        **_sum(lambda: _on("return", "gross_amount"), "returns"),
        label="Devoluções",
        synonyms=("devoluções", "returns"),
    ),
    Measure(
        "Discounts",
        **_sum(lambda: F.col("discount_amount"), "discounts"),
        label="Descontos",
        synonyms=("descontos",),
    ),
    Measure(
        "Cost of Sales",
        **_sum(
            lambda: F.when(F.col("transaction_type") == "sale", F.col("quantity") * F.col("unit_cost")), "cost_of_sales"
        ),
        optional_columns=("unit_cost",),
        label="Custo das Vendas",
        synonyms=("CMV", "custo", "COGS"),
    ),
    Measure(
        "Quantity",
        **_sum(lambda: _on("sale", "quantity"), "quantity"),
        kind="number",
        label="Quantidade",
        synonyms=("quantidade", "qty"),
    ),
    Measure(
        "Customers Current",
        # the filter makes Spark sum the other measures apart from the distinct customers, not once for each of them
        base=lambda: F.expr("count(DISTINCT customer_key) FILTER (WHERE transaction_type = 'sale')"),
        distinct="customer_key",
        kind="number",
        label="Clientes Ativos",
        synonyms=("clientes", "customers"),
    ),
    Measure(
        "Net Sales",
        derived=lambda m: or_zero(m("Gross Sales")) - or_zero(m("Discounts")) - or_zero(m("Returns")),
        uses=("Gross Sales", "Discounts", "Returns"),
        label="Vendas Líquidas",
        synonyms=("vendas líquidas", "net revenue"),
    ),
    Measure(
        "Gross Margin",
        derived=lambda m: m("Net Sales") - or_zero(m("Cost of Sales")),
        uses=("Net Sales", "Cost of Sales"),
        label="Margem Bruta",
        synonyms=("margem bruta", "gross profit"),
    ),
    Measure(
        "Gross Margin %",
        derived=lambda m: ratio(
            or_zero(m("Gross Sales")) - or_zero(m("Cost of Sales")), m("Gross Sales")
        ),
        uses=("Gross Sales", "Cost of Sales"),
        kind="percentage",
        label="Margem Bruta %",
        synonyms=("gross margin pct", "margem bruta percentual"),
    ),
    Measure(
        "Net Margin %",
        derived=lambda m: ratio(m("Net Sales") - or_zero(m("Cost of Sales")), m("Net Sales")),
        uses=("Net Sales", "Cost of Sales"),
        kind="percentage",
        label="Margem Líquida %",
        synonyms=("net margin pct", "margem líquida percentual"),
    ),
    Measure(
        "% Returns",
        derived=lambda m: ratio(or_zero(m("Returns")), m("Gross Sales")),
        uses=("Returns", "Gross Sales"),
        kind="percentage",
        label="Taxa de Devolução",
        synonyms=("taxa devolução", "return rate"),
    ),
    Measure(
        "Avg Unit Price",
        **_average(lambda: _on("sale", "unit_price"), "unit_price"),
        summed=lambda: ratio(F.sum(_on("sale", "unit_price")), F.sum(_on("sale", "priced_lines"))),
        label="Preço Unitário Médio",
        synonyms=("preço médio", "avg price"),
    ),
    Measure(
        "Avg Unit Cost",
        **_average(lambda: _on("sale", "unit_cost"), "unit_cost"),
        optional_columns=("unit_cost",),
        label="Custo Unitário Médio",
        synonyms=("custo médio", "avg cost"),
    ),
)


def commercial_view(mart: Mart) -> MetricView:
    """The cost lookup joins in only for measures that read ``unit_cost``."""
    return MetricView(
        "commercial",
        lambda optional: mart.sales_transactions(with_cost="unit_cost" in optional),
        DIMENSIONS,
        MEASURES,
        lambda optional, keep: mart.sales_transactions(with_cost="unit_cost" in optional, keep=keep),
    )
