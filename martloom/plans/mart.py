"""A lazy mart: every table is a DataFrame built on first use from a silver source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from martloom.plans import gold, semantic
from martloom.plans.contracts import CONTRACTS, tables_for

PROJECTIONS = {
    "dim_customer": "customer",
    "dim_account": "account",
    "dim_account_header": "account_header",
    "dim_organization": "organization",
    "dim_department_group": "department_group",
    "dim_region": "region",
    "fct_finance": "finance",
    "fct_sales_returns": "sales_returns",
    "fct_product_cost_history": "product_cost_history",
}


#: Silver tables that the other gold tables are composed from.
COMPOSED = {
    "dim_geography": ("geography", "region"),
    "dim_product": ("product", "product_sub_category"),
    "dim_calendar": ("finance", "sales_header", "sales_returns"),
    "fct_sales_details": ("sales_details", "sales_header"),
}


class Mart:
    """``silver`` and ``gold`` map a table name to a DataFrame.

    Without ``gold`` the star is composed from silver; with it (stored tables, say) the
    semantic layer reads the given tables and nothing upstream runs.
    """

    def __init__(
        self,
        silver: Callable[[str], DataFrame],
        gold: Callable[[str], DataFrame] | None = None,
        loaded_at: Column | None = None,
    ) -> None:
        self._silver_source = silver
        self._gold_source = gold or self._compose
        self._stored = gold is not None
        self._loaded_at = loaded_at
        self._cache: dict[tuple[str, str], DataFrame] = {}

    def over(self, gold: Callable[[str], DataFrame]) -> Mart:
        """The same mart with its gold tables read through ``gold``."""
        other = Mart(self._silver_source, gold)
        other._stored = self._stored
        return other

    def for_domain(self, domain: str) -> Mart:
        """The mart as a domain sees it: its own tables and the shared ones, an error for any other."""
        allowed = set(tables_for(domain))

        def seen(name: str) -> DataFrame:
            if name not in allowed:
                raise PermissionError(f"{name} is not open to {domain}")
            return self.gold(name)

        return self.over(seen)

    def _once(self, layer: str, name: str, build: Callable[[str], DataFrame]) -> DataFrame:
        if (layer, name) not in self._cache:
            self._cache[layer, name] = build(name)
        return self._cache[layer, name]

    def silver(self, name: str) -> DataFrame:
        return self._once("silver", name, self._silver_source)

    def gold(self, name: str) -> DataFrame:
        return self._once("gold", name, self._gold_source)

    @staticmethod
    def sources(name: str) -> tuple[str, ...]:
        """The silver tables that a gold table is made of."""
        return (PROJECTIONS[name],) if name in PROJECTIONS else COMPOSED[name]

    def _compose(self, name: str) -> DataFrame:
        s, at = self.silver, self._loaded_at
        if name in PROJECTIONS:
            return gold.projection(name, s(PROJECTIONS[name]), at)
        if name == "dim_geography":
            return gold.dim_geography(s("geography"), s("region"), at)
        if name == "dim_product":
            return gold.dim_product(s("product"), s("product_sub_category"), at)
        if name == "dim_calendar":
            return gold.dim_calendar(s("finance"), s("sales_header"), s("sales_returns"), at)
        if name == "fct_sales_details":
            return gold.fct_sales_details(s("sales_details"), s("sales_header"), at)
        raise KeyError(name)

    def transactions_view(self) -> DataFrame:
        """The whole flat view: lines travel without the names of their places, which are looked up at the end."""
        return semantic.with_places(self.sales_transactions(brief=True), self.gold("dim_geography"))

    def sales_transactions(
        self, with_cost: bool = True, keep: frozenset[str] | None = None, brief: bool = False
    ) -> DataFrame:
        """From the stored sales fact, or composed with buyers joined at order level.

        With ``keep``, figures are summed over those columns; see ``semantic.transactions``. In ``brief``, places
        lack their names; queries that read few of the columns need not, as the others never travel.
        """
        g, s = self.gold, self.silver
        cost = g("fct_product_cost_history") if with_cost else None
        if self._stored:
            return semantic.sales_transactions(
                g("fct_sales_details"),
                g("fct_sales_returns"),
                g("dim_customer"),
                g("dim_geography"),
                g("dim_product"),
                cost,
                keep,
                brief,
            )
        buyers = semantic.located_customers(g("dim_customer"), g("dim_geography"), brief)
        details = semantic.known_products(s("sales_details"), g("dim_product"), keep)
        returns = semantic.known_products(g("fct_sales_returns"), g("dim_product"), keep)
        return semantic.transactions(
            gold.sales_of_buyers(details, s("sales_header"), buyers),
            returns.join(buyers, "customer_key"),
            g("dim_product"),
            cost,
            keep,
        )

    def income_statement(self, join_calendar: bool = False) -> DataFrame:
        """Day attributes come from the date; ``join_calendar`` lets a calendar's own take precedence."""
        g = self.gold
        return semantic.income_statement(
            g("fct_finance"),
            g("dim_account"),
            g("dim_account_header"),
            g("dim_organization"),
            g("dim_department_group"),
            g("dim_calendar") if join_calendar else None,
        )

    def register_views(self, spark: SparkSession) -> None:
        """Every gold table and both flat views as temporary views, for plain SQL."""
        for table in CONTRACTS:
            self.gold(table).createOrReplaceTempView(table)
        self.sales_transactions().createOrReplaceTempView("v_sales_transactions")
        self.income_statement().createOrReplaceTempView("v_income_statement")
