"""Adapter: the TPC-H-shaped sample tables seen as the retail and finance source tables.

``SampleTables.typed`` gives silver-shaped frames; ``SampleTables.bronze`` renders the same
rows as an operational source would deliver them (text dates, decimal commas, padded and
capitalised text, a stale copy of every row with a lower id). Only fixed arithmetic is used,
so an independent SQL statement can restate every value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.text import decimal_comma_text
from martloom.operators.quality import enforce
from martloom.plans.mart import Mart
from martloom.plans.silver import SPECS

MONEY = "decimal(18,4)"
CENTS = "decimal(18,2)"
N_ACCOUNTS, N_HEADERS, N_ORGANIZATIONS, N_DEPARTMENTS, N_REGIONS = 35, 10, 9, 7, 5


def _key(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("bigint")


def _order_number(key: Column) -> Column:
    return F.concat(F.lit("SO"), key.cast("string"))


def _subcategory_key() -> Column:
    """Number for a (type, brand) pair: first letter and length tell the types apart."""
    kind = F.ascii("p_type") * 100 + F.length("p_type")
    return _key(kind * 100 + F.substring("p_brand", 7, 10).cast("int"))


def _hundredths(column: str) -> Column:
    """A two-place double as a whole number: exact to add up, and far cheaper than a decimal per line."""
    return F.rint(F.col(column) * 100).cast("bigint")


def _ten_thousandths(whole: Column) -> Column:
    return (whole.cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(4,4)")).cast(MONEY)


def _unit_price() -> Column:
    """Line amount over quantity, rounded half up to four places in whole numbers."""
    quantity = F.col("l_quantity").cast("bigint")
    doubled = _hundredths("l_extendedprice") * 200 + quantity
    return _ten_thousandths(F.call_function("div", doubled, quantity * 2))


class SampleTables:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def landing(self, table: str) -> str:
        """The table's files as a pattern, the form a file stream accepts for part of a folder."""
        return f"{self.sf_dir}/{table}.*"

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self.path(table))

    def mart(self) -> Mart:
        return Mart(self.typed)

    def typed(self, table: str) -> DataFrame:
        """Silver-shaped frame; finance entries outside actual/budget are dropped by rule."""
        df = getattr(self, f"_{table}")()
        return enforce(df, SPECS["finance"].rules) if table == "finance" else df

    def _region(self) -> DataFrame:
        return self.read("region").select(
            _key("r_regionkey").alias("region_key"),
            F.col("r_name").alias("region_name"),
            F.col("r_name").alias("country"),
            F.col("r_name").alias("continent"),
        )

    def _geography(self) -> DataFrame:
        return self.read("nation").select(
            _key("n_nationkey").alias("geography_key"),
            _key("n_regionkey").alias("region_key"),
            *[
                F.col("n_name").alias(c)
                for c in ("city_name", "state_code", "state_name", "country_code", "country_name")
            ],
        )

    def _customer(self) -> DataFrame:
        return self.read("customer").select(
            _key("c_custkey").alias("customer_key"),
            _key("c_nationkey").alias("geography_key"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("business_type"),
            (F.col("c_custkey") % 500).cast("int").alias("number_employees"),
            F.col("c_acctbal").cast(CENTS).alias("annual_revenue"),
            (1990 + F.col("c_custkey") % 30).cast("int").alias("year_opened"),
        )

    def _product(self) -> DataFrame:
        return self.read("part").select(
            _key("p_partkey").alias("product_key"),
            _subcategory_key().alias("product_subcategory_key"),
            F.col("p_name").alias("product_name"),
            F.col("p_size").cast("string").alias("size"),
            F.col("p_brand").alias("detail"),
        )

    def _product_sub_category(self) -> DataFrame:
        return (
            self.read("part")
            .select(
                _subcategory_key().alias("product_subcategory_key"),
                F.concat_ws("/", "p_type", "p_brand").alias("subcategory_name"),
                F.col("p_type").alias("category_name"),
            )
            .distinct()
        )

    def _account(self) -> DataFrame:
        key = F.col("account_key")
        return (
            self.read("customer")
            .select(_key(F.col("c_custkey") % N_ACCOUNTS).alias("account_key"))
            .distinct()
            .select(
                "account_key",
                _key(key % N_HEADERS + 1).alias("account_header_key"),
                _key(key % 4).alias("account_subheader_key"),
                F.concat(F.lit("Account "), key.cast("string")).alias("account_name"),
                F.when(key % 3 == 0, "Expense").otherwise("Revenue").alias("account_type"),
                F.concat(F.lit("Subheader "), (key % 4).cast("string")).alias("account_subheader"),
                (key % 4).cast("int").alias("subheader_detail"),
                F.when(key % 3 == 0, -1).otherwise(1).cast("int").alias("sign"),
            )
        )

    def _account_header(self) -> DataFrame:
        key = F.col("account_header_key")
        return (
            self._account()
            .select("account_header_key")
            .distinct()
            .select(
                "account_header_key",
                F.when(key == 3, "Net Sales")
                .otherwise(F.concat(F.lit("Header "), key.cast("string")))
                .alias("account_header_name"),
                key.cast("int").alias("header_detail"),
            )
        )

    def _organization(self) -> DataFrame:
        key = F.col("organization_key")
        return (
            self.read("nation")
            .select(_key(F.col("n_nationkey") % N_ORGANIZATIONS).alias("organization_key"))
            .distinct()
            .select(
                "organization_key",
                F.concat(F.lit("Unit "), key.cast("string")).alias("organization_name"),
                F.concat(F.lit("Division "), (key % 3).cast("string")).alias("parent_organization"),
            )
        )

    def _department_group(self) -> DataFrame:
        key = F.col("department_group_key")
        return (
            self.read("nation")
            .select(_key(F.col("n_nationkey") % N_DEPARTMENTS).alias("department_group_key"))
            .distinct()
            .select(
                "department_group_key",
                F.concat(F.lit("Department "), key.cast("string")).alias("department_group_name"),
            )
        )

    def _finance(self) -> DataFrame:
        status = F.col("o_orderstatus")
        return self.read("orders").select(
            _key("o_orderkey").alias("finance_key"),
            _key(F.col("o_custkey") % N_ACCOUNTS).alias("account_key"),
            _key(F.col("o_custkey") % N_ORGANIZATIONS).alias("organization_key"),
            _key(F.col("o_orderkey") % N_DEPARTMENTS).alias("department_group_key"),
            F.when(status == "F", "actual").when(status == "O", "budget").otherwise("invalid")
            .alias("scenario"),
            F.col("o_orderdate").cast("date").alias("transaction_date"),
            F.col("o_totalprice").cast(MONEY).alias("amount"),
        )

    def _sales_header(self) -> DataFrame:
        per_order = self.read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
            F.max(F.col("l_shipdate").cast("date")).alias("ship_date"),
            F.sum(_hundredths("l_extendedprice") * _hundredths("l_discount")).alias("discount_e4"),
        )
        # dates and amounts are made before the join, where they are shuffled: they are narrower than what they come from
        orders = self.read("orders").select(
            "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        )
        ordered, total = F.col("order_date"), F.col("total_amount")
        discount = _ten_thousandths(F.coalesce(F.col("discount_e4"), F.lit(0)))
        # a computed key: joins on it shuffle the header anew, as they would a stored table, and
        # two plain shuffles are what lets AQE split an order that holds much of the lines
        order_key = F.col("o_orderkey").cast("decimal(20,0)")
        return (
            orders.join(per_order, "o_orderkey", "left")
            .select(
                _key(order_key).alias("sales_header_key"),
                _key("o_custkey").alias("customer_key"),
                _key(F.col("o_custkey") % N_REGIONS).alias("region_key"),
                _order_number(F.col("o_orderkey")).alias("sales_order_number"),
                ordered,
                F.date_add(ordered, 30).alias("due_date"),
                "ship_date",
                discount.alias("discount_amount"),
                total,
                (total - discount).cast(MONEY).alias("sales_amount"),
            )
        )

    def _sales_details(self) -> DataFrame:
        return self.read("lineitem").select(
            _key(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sales_details_key"),
            _key("l_orderkey").alias("sales_header_key"),
            _key("l_partkey").alias("product_key"),
            _key(F.col("l_partkey") % 150).alias("product_subcategory_key"),
            _order_number(F.col("l_orderkey")).alias("sales_order_number"),
            F.col("l_quantity").cast("int").alias("order_quantity"),
            _unit_price().alias("unit_price"),
            F.col("l_extendedprice").cast(MONEY).alias("extended_amount"),
        )

    def _sales_returns(self) -> DataFrame:
        orders = self.read("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderdate").cast("date").alias("order_date")
        )
        return (
            self.read("lineitem")
            .filter("l_returnflag = 'R'")
            .select(
                "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
                F.col("l_shipdate").cast("date").alias("ship_date"),
            )
            .join(orders, "l_orderkey")
            .select(
                _key(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("return_key"),
                _key("o_custkey").alias("customer_key"),
                _key("l_partkey").alias("product_key"),
                _order_number(F.col("l_orderkey")).alias("sales_order_number"),
                F.date_add("ship_date", 14).alias("return_date"),
                "order_date",
                F.col("l_quantity").cast("int").alias("return_quantity"),
                _unit_price().alias("unit_price"),
                F.col("l_extendedprice").cast(MONEY).alias("return_amount"),
            )
        )

    def _product_cost_history(self) -> DataFrame:
        """Costs known for product-months with a settled line (flag A or R), so some sales have none.

        Orders find the country before they meet their lines, which are several times as many. Months are made
        distinct where their product is, so neither the price nor a lookup by product moves them again.
        """
        ordered = F.col("o_orderdate").cast("date")
        orders = (
            self.read("orders")
            .select(
                F.col("o_orderkey").alias("l_orderkey"),
                F.col("o_custkey").alias("c_custkey"),
                (F.year(ordered) * 12 + F.month(ordered) - 1).alias("_month"),  # one column to carry
            )
            .join(self.read("customer").select("c_custkey", "c_nationkey"), "c_custkey")
        )
        settled = (
            self.read("lineitem")
            .filter("l_returnflag <> 'N'")
            .select("l_orderkey", "l_partkey")
            .join(orders, "l_orderkey")
            .select(F.col("l_partkey").alias("p_partkey"), "_month", "c_nationkey")
            .repartition("p_partkey")
            .distinct()
            .withColumns({"year": F.floor(F.col("_month") / 12).cast("int"), "month_no": F.pmod("_month", F.lit(12)) + 1})
        )
        share = F.lit("0.50").cast("decimal(4,2)") + F.col("month_no").cast("decimal(4,0)") * F.lit("0.01").cast("decimal(2,2)")
        return (
            settled.join(self.read("part").select("p_partkey", "p_retailprice"), "p_partkey")
            .join(
                self.read("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"),
                "c_nationkey",
            )
            .select(
                _key("p_partkey").alias("product_key"),
                F.col("n_name").alias("country_code"),
                "year",
                "month_no",
                (F.col("p_retailprice").cast(CENTS) * share).cast(MONEY).alias("unit_cost"),
            )
        )

    def bronze(self, table: str) -> DataFrame:
        """The same rows as raw source text, each with a stale earlier version."""
        spec = SPECS[table]
        typed = getattr(self, f"_{table}")()
        if table == "sales_details" or table == "sales_returns":
            # these keys repeat in the sample, so the line's own content orders the versions
            typed = self._with_line_rank(typed)
            row_id = F.col("_line_rank")
        elif table == "product_cost_history":
            row_id = F.col("product_key")
        else:
            row_id = F.col(spec.fields[0].name)
        columns = [(row_id * 2 + F.col("_version")).cast("bigint").cast("string").alias("id")]
        key_sources = set(spec.dedup_key)
        for f in spec.fields:
            value = F.col(f.name)
            if f.reads_as == "date":
                value = F.date_format(value, "dd/MM/yyyy")
            elif f.reads_as in ("money", "revenue"):
                value = decimal_comma_text(value)
            elif f.reads_as == "lower":
                value = F.concat(F.lit(" "), F.initcap(value))
            elif f.reads_as == "text" and f.source in key_sources:
                value = F.when(F.col("_version") == 1, F.concat(value, F.lit(" "))).otherwise(value)
            elif f.reads_as == "text":
                current = F.concat(F.lit("  "), value, F.lit(" "))
                value = F.when(F.col("_version") == 1, current).otherwise(F.lit("stale"))
            columns.append(value.alias(f.source))
        versions = F.explode(F.array(F.lit(0), F.lit(1))).alias("_version")
        return typed.select("*", versions).select(*columns)

    @staticmethod
    def _with_line_rank(df: DataFrame) -> DataFrame:
        amount = F.col("extended_amount" if "extended_amount" in df.columns else "return_amount")
        rank = F.col("product_key") * 100_000_000 + (amount * 100).cast("bigint")
        return df.withColumn("_line_rank", rank.cast("bigint"))
