"""Declared gold tables: column order, types, comments, keys, and governance tags."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    comment: str


@dataclass(frozen=True)
class TableContract:
    name: str
    comment: str
    columns: tuple[ContractColumn, ...]
    primary_key: tuple[str, ...]
    required: str | None = None
    indexes: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    domain: str | None = None
    pii: bool = False

    def tags(self) -> dict[str, str]:
        tags = {"domain": self.domain} if self.domain else {}
        return tags | ({"pii": "true"} if self.pii else {})


def _columns(text: str) -> tuple[ContractColumn, ...]:
    """Lines of ``name type comment``."""
    return tuple(ContractColumn(*line.split(None, 2)) for line in text.strip().splitlines())


# Domain tags, primary keys, index columns.
COMMERCIAL, FINANCE = "comercial", "financeiro"

CONTRACTS: dict[str, TableContract] = {
    c.name: c
    for c in (
        TableContract(
            "dim_customer",
            "Who buys. One row per customer.",
            _columns("""
                customer_key bigint Business key of the customer
                geography_key bigint Where the customer is, see dim_geography
                customer_name string Customer name
                business_type string Kind of business the customer runs
                number_employees int Head count
                annual_revenue decimal(18,2) Declared yearly revenue in USD
                year_opened int Year the business opened
            """),
            ("customer_key",), "customer_key", ("geography_key",), (), COMMERCIAL, True,
        ),
        TableContract(
            "dim_geography",
            "City up to continent. One row per location.",
            _columns("""
                geography_key bigint Business key of the location
                region_key bigint Sales region, the level used by row filters
                continent string Continent
                region_name string Sales region name
                country_code string Country code
                country_name string Country name
                state_code string State or province code
                state_name string State or province name
                city_name string City
            """),
            ("geography_key",), "geography_key", ("region_key",),
        ),
        TableContract(
            "dim_product",
            "Product, subcategory, category. One row per product.",
            _columns("""
                product_key bigint Business key of the product
                product_subcategory_key bigint Subcategory of the product
                category_name string Category, top of the hierarchy
                subcategory_name string Subcategory
                product_name string Product name
                size string Package size
                detail string Free description
            """),
            ("product_key",), "product_key", ("product_subcategory_key",), (), COMMERCIAL,
        ),
        TableContract(
            "dim_account",
            "Ledger accounts. One row per account.",
            _columns("""
                account_key bigint Business key of the account
                account_header_key bigint Top line of the income statement
                account_subheader_key bigint Middle line of the income statement
                account_name string Account name
                account_type string Account type
                account_subheader string Middle line label
                subheader_detail int Order within the middle line
                sign int +1 or -1, applied when composing the income statement
            """),
            ("account_key",), "account_key", ("account_header_key",), (), FINANCE,
        ),
        TableContract(
            "dim_account_header",
            "Top lines of the income statement. One row per header.",
            _columns("""
                account_header_key bigint Business key of the header
                account_header_name string Header label
                header_detail int Display order
            """),
            ("account_header_key",), "account_header_key", (), (), FINANCE,
        ),
        TableContract(
            "dim_organization",
            "Organizational units. One row per unit.",
            _columns("""
                organization_key bigint Business key of the unit
                organization_name string Unit name
                parent_organization string Parent unit
            """),
            ("organization_key",), "organization_key", (), (), FINANCE,
        ),
        TableContract(
            "dim_department_group",
            "Groups of departments. One row per group.",
            _columns("""
                department_group_key bigint Business key of the group
                department_group_name string Group name
            """),
            ("department_group_key",), "department_group_key", (), (), FINANCE,
        ),
        TableContract(
            "dim_calendar",
            "Generated calendar covering every fact date. One row per day.",
            _columns("""
                date_key int Date as yyyyMMdd
                full_date date The day, joined to fact dates
                year int Year
                quarter int Quarter 1-4
                month int Month 1-12
                month_name string Portuguese month name
                day int Day of month
                day_of_week int 1 is Sunday, 7 is Saturday
                week_of_year int ISO week
                is_weekend boolean Saturday or Sunday
            """),
            ("date_key",), None, (), (("full_date",),),
        ),
        TableContract(
            "dim_region",
            "Sales regions. One row per region.",
            _columns("""
                region_key bigint Business key of the region
                region_name string Region name
                country string Country of the region
                continent string Continent of the region
            """),
            ("region_key",), "region_key",
        ),
        TableContract(
            "fct_sales_details",
            "Sales at order-line grain with the order discount spread over its lines.",
            _columns("""
                sales_details_key bigint Business key of the line
                sales_header_key bigint Order the line belongs to
                customer_key bigint Buyer, from the order
                product_key bigint Product sold
                region_key bigint Region of the order
                order_date date Day ordered
                due_date date Day promised
                ship_date date Day shipped
                sales_order_number string Order number
                order_quantity int Units
                unit_price decimal(18,4) Price per unit
                gross_sales decimal(18,4) Line amount before discount
                discount_allocated decimal(18,4) Share of the order discount on this line
                net_sales decimal(18,4) Line amount after discount
                lead_time_days int Order to ship, average only
                promised_lead_time_days int Order to due, average only
                delivery_delay_days int Due to ship, average only
                is_late boolean Shipped after the due date
            """),
            ("sales_details_key",), "sales_details_key",
            ("customer_key", "product_key", "region_key", "sales_header_key", "order_date"),
            (), COMMERCIAL,
        ),
        TableContract(
            "fct_sales_returns",
            "Returned goods. One row per return.",
            _columns("""
                return_key bigint Business key of the return
                customer_key bigint Customer returning
                product_key bigint Product returned
                return_date date Day returned
                order_date date Day of the original order
                sales_order_number string Original order number
                return_quantity int Units returned
                unit_price decimal(18,4) Price per unit
                return_amount decimal(18,4) Amount returned
            """),
            ("return_key",), "return_key", ("customer_key", "product_key", "return_date"),
            (), COMMERCIAL,
        ),
        TableContract(
            "fct_finance",
            "Ledger entries, actual and budget. One row per entry.",
            _columns("""
                finance_key bigint Business key of the entry
                account_key bigint Ledger account
                organization_key bigint Organizational unit
                department_group_key bigint Department group
                transaction_date date Day of the entry
                scenario string actual or budget
                amount decimal(18,4) Unsigned amount in USD
            """),
            ("finance_key",), "finance_key",
            ("account_key", "organization_key", "department_group_key", "transaction_date"),
            (), FINANCE,
        ),
        TableContract(
            "fct_product_cost_history",
            "Unit cost per product, month and country.",
            _columns("""
                product_key bigint Product
                year int Year of the cost
                month_no int Month of the cost
                country_code string Country of the cost
                unit_cost decimal(18,4) Cost per unit
            """),
            ("product_key", "year", "month_no", "country_code"), "product_key", ("product_key",),
        ),
    )
}


def apply_contract(df: DataFrame, contract: TableContract, loaded_at: Column | None = None) -> DataFrame:
    """Declared order and types, comments as column metadata, rows without a key dropped."""
    if contract.required:
        df = df.filter(F.col(contract.required).isNotNull())
    columns = [
        F.col(c.name).cast(c.type).alias(c.name, metadata={"comment": c.comment})
        for c in contract.columns
    ]
    if loaded_at is not None:
        columns.append(loaded_at.alias("_gold_loaded_at", metadata={"comment": "Load time"}))
    return df.select(*columns)


def tables_for(domain: str) -> list[str]:
    """Gold tables a domain may see: its own plus the untagged shared ones."""
    return sorted(c.name for c in CONTRACTS.values() if c.domain in (domain, None))


def contract_profile(frames: Iterable[tuple[TableContract, DataFrame]]) -> DataFrame:
    """Per declared column: type, comment and how many rows carry a value (one pass per table)."""
    parts = []
    for contract, df in frames:
        counts = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count(F.col(c.name)).alias(f"_n{i}") for i, c in enumerate(contract.columns)],
        )
        entries = F.array(
            *[
                F.struct(
                    F.lit(contract.name).alias("table_name"),
                    F.lit(c.name).alias("column_name"),
                    F.lit(df.schema[c.name].dataType.simpleString()).alias("column_type"),
                    F.lit(df.schema[c.name].metadata.get("comment", "")).alias("comment"),
                    F.lit(contract.domain).alias("domain"),
                    F.lit(c.name in contract.primary_key).alias("in_primary_key"),
                    F.col("_rows").alias("total_rows"),
                    F.col(f"_n{i}").alias("filled_rows"),
                )
                for i, c in enumerate(contract.columns)
            ]
        )
        parts.append(counts.select(F.inline(entries)))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
