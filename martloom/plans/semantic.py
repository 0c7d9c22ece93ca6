"""The two flat consumption views: sales transactions and the income statement."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.plans.gold import calendar_attributes

MONEY = "decimal(18,4)"

PLACE_AND_PRODUCT = (
    "customer_name", "business_type",
    "region_name", "country_name", "state_name", "city_name", "continent",
    "category_name", "subcategory_name", "product_name",
)
PRODUCT_NAMES = ("category_name", "subcategory_name", "product_name")
#: Columns that ask more of a product than to be known.
PRODUCT_KEPT = (*PRODUCT_NAMES, "product_key")
TRANSACTION_COLUMNS = (
    "transaction_type", "customer_key", "product_key", "region_key", *PLACE_AND_PRODUCT,
    "order_date", "order_year", "order_month", "quantity", "unit_price",
    "gross_amount", "discount_amount", "unit_cost",
)


def located_customers(customer: DataFrame, geography: DataFrame, brief: bool = False) -> DataFrame:
    """Customers with their place; joining the two dimensions first keeps the fact joins at two.

    In ``brief``, a place is its keys and its region's name only; ``with_places`` adds the rest.
    """
    places = _places(geography)
    return customer.select("customer_key", "geography_key", "customer_name", "business_type").join(
        places.select(*PLACE_KEY).distinct() if brief else places, "geography_key"
    )


def _places(geography: DataFrame) -> DataFrame:
    return geography.select(
        "geography_key", F.col("region_key").alias("home_region_key"), "region_name",
        "country_code", "country_name", "state_name", "city_name", "continent",
    )


def with_places(transactions: DataFrame, geography: DataFrame) -> DataFrame:
    """Transactions of briefly located customers with all names of their places.

    Names that every line would carry through its shuffles are looked up in place: the geography
    of customers is a list of cities, small enough for every task.
    """
    places = _places(geography).select(*[F.col(c).alias(f"_{c}" if c in PLACE_KEY else c) for c in _places(geography).columns])
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE_KEY])
    return transactions.join(F.broadcast(places), same).select(*TRANSACTION_COLUMNS)


#: What a place is known by until its names are looked up: what filters and the lookup of costs read.
PLACE_KEY = ("geography_key", "home_region_key", "region_name", "country_code")
BUYER_COLUMNS = (
    "geography_key",
    "customer_name", "business_type", "home_region_key", "region_name", "country_code",
    "country_name", "state_name", "city_name", "continent",
)


def _stored_or(df: DataFrame, column: str, computed: Column) -> Column:
    """A column that stored facts are partitioned by, or what it is computed from."""
    return F.col(column) if column in df.columns else computed


def _lines(df: DataFrame, kind: str, quantity: str) -> DataFrame:
    """Columns sales and returns share, still with the buyer's place."""
    return df.select(
        F.lit(kind).alias("transaction_type"),
        "customer_key", "product_key", "order_date",
        _stored_or(df, "order_year", F.year("order_date")).alias("order_year"),
        F.month("order_date").alias("order_month"),
        F.col(quantity).alias("quantity"),
        "unit_price",
        (F.col(quantity) * F.col("unit_price")).cast(MONEY).alias("gross_amount"),
        *(c for c in BUYER_COLUMNS if c in df.columns),
        *(c for c in ("region_key", "discount_allocated") if c in df.columns),
    )


def sales_transactions(
    sales: DataFrame,
    returns: DataFrame,
    customer: DataFrame,
    geography: DataFrame,
    product: DataFrame,
    cost_history: DataFrame | None,
    keep: frozenset[str] | None = None,
    brief: bool = False,
) -> DataFrame:
    """Sale and return lines with customer, place and product names, and the sale's unit cost.

    In ``brief``, places have only what ``with_places`` finds their names by.
    """
    buyers = located_customers(customer, geography, brief)
    sales, returns = known_products(sales, product, keep), known_products(returns, product, keep)
    return transactions(
        sales.join(buyers, "customer_key"), returns.join(buyers, "customer_key"), product, cost_history, keep
    )


def known_products(lines: DataFrame, product: DataFrame, keep: frozenset[str] | None) -> DataFrame:
    """Lines of known products where only that is asked of the product.

    With no attribute of products in ``keep``, plain lines meet them while they are narrow: summed by product
    first, they would hardly be fewer, and wide.
    """
    if keep is None or not keep.isdisjoint(PRODUCT_KEPT):
        return lines
    return lines.join(product.select("product_key"), "product_key")


def _summed(lines: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Figures of the lines summed over ``keys``, with the number of lines and of those with a price."""
    figures = [c for c in ("quantity", "unit_price", "gross_amount", "discount_amount") if c in lines.columns]
    return lines.groupBy("transaction_type", *keys).agg(
        *[F.sum(c).alias(c) for c in figures],
        F.count("unit_price").alias("priced_lines"), F.count(F.lit(1)).alias("lines"),
    )


def transactions(
    sales: DataFrame,
    returns: DataFrame,
    product: DataFrame,
    cost_history: DataFrame | None,
    keep: frozenset[str] | None = None,
) -> DataFrame:
    """As ``sales_transactions``, from facts that carry their buyers.

    Sales keep the order's region key; returns have none and take the customer's. The region
    *name* is the customer's for both. Lines whose customer or product is unknown drop out.
    The cost lookup (product, year, month, country of the buyer) is unique on its key, so it
    never changes the number of rows; pass no history to leave it out when no cost is read.

    Amounts that follow from other columns are worked out after the joins. Lines with costs are shuffled by product
    once, for their cost and their product (see ``_costed``).

    With ``keep``, quantities, prices and amounts are summed over those columns, and ``lines`` and ``priced_lines``
    count what went in. Where attributes of products are kept, lines are summed by product as well before they
    meet it: only sums are shuffled to the dimension. Where none is, the facts given hold only lines
    of known products (see ``known_products``). Costs are looked up by month and country, over which lines
    hardly add up, so they come with whole lines only.
    """
    if keep is not None and cost_history is not None:
        raise ValueError("lines that were summed cannot meet their costs")
    if keep is None:
        return _whole_lines(sales, returns, product, cost_history)
    kept = tuple(c for c in TRANSACTION_COLUMNS if c in keep)
    columns = tuple(dict.fromkeys(
        ("transaction_type", *kept, "quantity", "unit_price", "gross_amount", "discount_amount", "unit_cost", "lines", "priced_lines")
    ))
    names = tuple(c for c in PRODUCT_NAMES if c in kept)
    own = [c for c in kept if c not in names]

    def summed(lines: DataFrame) -> DataFrame:
        if keep.isdisjoint(PRODUCT_KEPT):
            return _summed(lines, own)
        return _summed(lines, dict.fromkeys((*own, "product_key"))).join(product.select("product_key", *names), "product_key")

    sold = summed(_sold(sales)).withColumn("unit_cost", F.lit(None).cast(MONEY))
    returned = summed(_returned(returns)).withColumns(_not_returned())
    return sold.select(*columns).unionByName(returned.select(*columns))


def _sold(sales: DataFrame) -> DataFrame:
    return _lines(sales, "sale", "order_quantity").withColumnRenamed("discount_allocated", "discount_amount")


def _returned(returns: DataFrame) -> DataFrame:
    return _lines(returns, "return", "return_quantity").withColumn("region_key", F.col("home_region_key"))


def _not_returned() -> dict[str, Column]:
    """What a return never has: a discount and a cost."""
    return {"discount_amount": F.lit(0).cast(MONEY), "unit_cost": F.lit(None).cast(MONEY)}


def _whole_lines(
    sales: DataFrame, returns: DataFrame, product: DataFrame, cost_history: DataFrame | None
) -> DataFrame:
    items = product.select("product_key", *PRODUCT_NAMES)
    sold = _sold(sales).drop("gross_amount")
    if cost_history is None:
        sold = sold.withColumn("unit_cost", F.lit(None).cast(MONEY))
    else:
        sold = _costed(sold.drop("transaction_type"), cost_history).withColumn("transaction_type", F.lit("sale"))
    returned = _returned(returns).drop("gross_amount").withColumns(_not_returned())
    columns = TRANSACTION_COLUMNS
    if "country_name" not in sales.columns:
        columns = tuple(c for c in dict.fromkeys((*columns, *PLACE_KEY)) if c in (*sold.columns, *PRODUCT_NAMES, "gross_amount"))
    gross = (F.col("quantity") * F.col("unit_price")).cast(MONEY)

    def named(lines: DataFrame) -> DataFrame:
        return lines.join(items, "product_key").withColumn("gross_amount", gross).select(*columns)

    return named(sold).unionByName(named(returned))


def _costed(sold: DataFrame, cost_history: DataFrame) -> DataFrame:
    """Sales with the cost of their product, month and country: a left join, row for row.

    Sales and costs lie together by product, so one shuffle serves this lookup and the join with products after it;
    a join by the four columns would shuffle every line once more. A key without a value finds no cost.
    """
    key = ("product_key", "order_year", "order_month", "country_code")
    costs = cost_history.select(
        "product_key",
        F.col("year").alias("order_year"),
        F.col("month_no").alias("order_month"),
        "country_code",
        F.struct("unit_cost").alias("_cost"),
    )
    both = sold.withColumn("_sold", F.lit(True)).unionByName(costs, allowMissingColumns=True).repartition("product_key")
    valued = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
    found = F.when(valued, F.collect_list("_cost").over(Window.partitionBy(*key)))
    lines = both.withColumn("_costs", found).filter("_sold")
    return (
        lines.withColumn("_cost", F.explode_outer("_costs"))
        .withColumn("unit_cost", F.col("_cost.unit_cost"))
        .drop("_sold", "_costs", "_cost")
    )


def income_statement(
    finance: DataFrame,
    account: DataFrame,
    account_header: DataFrame,
    organization: DataFrame,
    department_group: DataFrame,
    calendar: DataFrame | None = None,
) -> DataFrame:
    """Ledger entries with account, unit, department and calendar, and the signed amount.

    Attributes of the day come from the date itself, so an entry is never lost to a calendar that
    ends before it. A ``calendar`` is left-joined: where it knows a day, its attributes hold. The year
    of a stored ledger is the column it is partitioned by.
    """
    chart = account.select(
        "account_key", "account_name", "account_type", "account_subheader", "sign",
        "account_header_key",
    ).join(account_header, "account_header_key")
    attributes = calendar_attributes(F.col("transaction_date"))
    attributes["year"] = _stored_or(finance, "transaction_year", attributes["year"])
    parts = ("quarter", "month", "month_name")
    dated = finance.filter(F.col("transaction_date").isNotNull())
    if calendar is None:
        dated = dated.withColumns({p: attributes[p] for p in ("year", *parts)})
    else:
        days = calendar.select(F.col("full_date").alias("transaction_date"), *[F.col(p).alias(f"_{p}") for p in parts])
        dated = dated.join(days, "transaction_date", "left").withColumns(
            {"year": attributes["year"]} | {p: F.coalesce(f"_{p}", attributes[p]) for p in parts}
        )
    return (
        dated.join(chart, "account_key")
        .join(organization, "organization_key")
        .join(department_group, "department_group_key")
        .select(
            "finance_key", "scenario",
            "account_key", "account_name", "account_type", "account_subheader",
            "account_header_key", "account_header_name", "header_detail",
            "organization_name", "parent_organization", "department_group_name",
            "transaction_date", "year", "quarter", "month", "month_name",
            "amount", "sign",
            (F.col("amount") * F.col("sign")).cast(MONEY).alias("signed_amount"),
        )
    )
