"""Monthly growth and the price-volume-mix decomposition of revenue changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions import dates
from martloom.functions.numbers import ratio

# Comparison bases and how many months back each looks.
COMPARISONS = (("MoM", 1), ("YoY", 12))
NO_SUBCATEGORY = "Sem subcategoria"


def time_intelligence(sales: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Gross sales per month against the previous and twelfth previous row.

    Lines are summed per day before meeting the calendar, so only days are joined, and the
    ordered window runs over months. Without a stored calendar the month is taken from the
    date, which gives the same rows. The change is divided by the current month.
    """
    daily = sales.groupBy(F.col("order_date").alias("full_date")).agg(
        F.sum("gross_sales").alias("_gross")
    )
    if calendar is None:
        day = F.col("full_date")
        dated = daily.filter(day.isNotNull()).withColumns({"year": F.year(day), "month": F.month(day)})
    else:
        dated = daily.join(calendar.select("full_date", "year", "month"), "full_date")
    monthly = (
        dated.groupBy("year", (F.col("year") * 100 + F.col("month")).alias("year_month"))
        .agg(F.sum("_gross").cast("decimal(28,4)").alias("gross_sales"))
    )
    by_month = Window.orderBy("year_month")
    gross = F.col("gross_sales")
    return (
        monthly.withColumn("gross_sales_prev_month", F.lag("gross_sales", 1).over(by_month))
        .withColumn("gross_sales_prev_year", F.lag("gross_sales", 12).over(by_month))
        .withColumn("mom_pct", ratio(gross - F.col("gross_sales_prev_month"), gross))
        .withColumn("yoy_pct", ratio(gross - F.col("gross_sales_prev_year"), gross))
    )


def subcategory_months(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Quantity and revenue per month and subcategory.

    Summed per product first: the partial sums leave the map side already reduced, and the
    product dimension is joined to product-months rather than to lines.
    """
    per_product = (
        sales.filter(F.col("order_date").isNotNull())
        .groupBy("product_key", dates.month_start(F.col("order_date")).alias("month_start"))
        .agg(F.sum("order_quantity").alias("qty"), F.sum("gross_sales").alias("rev"))
    )
    name = F.coalesce(F.col("subcategory_name"), F.lit(NO_SUBCATEGORY)).alias("subcategory")
    return (
        per_product.join(product.select("product_key", "subcategory_name"), "product_key")
        .groupBy("month_start", name)
        .agg(F.sum("qty").alias("qty"), F.sum("rev").cast("decimal(28,4)").alias("rev"))
    )


def pvm_pairs(months: DataFrame) -> DataFrame:
    """Every subcategory of a month or of its base month, current and base side by side.

    Each month row stands in four places: as itself and as another month's base, for both
    comparisons. Laying those out and grouping replaces the self joins, so the facts are
    read once. Months without a base month are left out.
    """
    places = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(kind).alias("comparison_type"),
                    F.add_months(F.col("month_start"), shift).alias("month_start"),
                    F.lit(shift == 0).alias("is_current"),
                )
                for kind, back in COMPARISONS
                for shift in (0, back)
            ]
        )
    )
    laid_out = months.select(places.alias("_p"), "subcategory", "qty", "rev").select(
        "_p.*", "subcategory", "qty", "rev"
    )
    now, base = F.col("is_current"), ~F.col("is_current")

    def total(where: Column, column: str) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(column))), F.lit(0))

    month = Window.partitionBy("comparison_type", "month_start")
    return (
        laid_out.groupBy("comparison_type", "month_start", "subcategory")
        .agg(
            total(now, "qty").alias("q1"),
            total(now, "rev").cast("decimal(28,4)").alias("rev1"),
            total(base, "qty").alias("q0"),
            total(base, "rev").cast("decimal(28,4)").alias("rev0"),
            F.count_if(now).alias("_now"),
            F.count_if(base).alias("_base"),
        )
        .withColumns(
            {
                "q_tot1": F.sum("q1").over(month),
                "q_tot0": F.sum("q0").over(month),
                "r_tot0": F.sum("rev0").over(month),
                "_now": F.sum("_now").over(month),
                "_base": F.sum("_base").over(month),
            }
        )
        .filter("_now > 0 AND _base > 0")
        .drop("_now", "_base")
    )


def price_volume_mix(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Revenue change per subcategory split into volume, price and the remaining mix effect."""
    pairs = pvm_pairs(subcategory_months(sales, product))
    double = {c: F.col(c).cast("double") for c in ("q1", "rev1", "q0", "rev0", "q_tot1", "q_tot0", "r_tot0")}
    values = pairs.withColumns(double)
    volume = F.when(F.col("q_tot0") == 0, 0.0).otherwise(
        (F.col("q_tot1") - F.col("q_tot0"))
        * ratio(F.col("q0"), F.col("q_tot0"))
        * ratio(F.col("r_tot0"), F.col("q_tot0"))
    )
    price = F.when((F.col("q0") == 0) | (F.col("q1") == 0), 0.0).otherwise(
        F.col("q1") * (ratio(F.col("rev1"), F.col("q1")) - ratio(F.col("rev0"), F.col("q0")))
    )
    return values.select(
        "comparison_type",
        dates.year_month(F.col("month_start")).alias("year_month"),
        "month_start",
        "subcategory",
        (F.col("rev1") - F.col("rev0")).alias("delta_revenue"),
        volume.alias("effect_volume"),
        price.alias("effect_price"),
        (F.col("rev1") - F.col("rev0") - volume - price).alias("effect_mix"),
    )


def pvm_closure(drivers: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Months whose effects do not add up to their change (none, by construction)."""
    effects = F.col("effect_volume") + F.col("effect_price") + F.col("effect_mix")
    return (
        drivers.groupBy("comparison_type", "year_month")
        .agg(
            F.round(F.sum(effects), 2).alias("soma_efeitos"),
            F.round(F.sum("delta_revenue"), 2).alias("delta_real"),
        )
        .filter(F.abs(F.col("soma_efeitos") - F.col("delta_real")) > tolerance)
    )


def served_pvm(drivers: DataFrame, comparison_type: str = "YoY", year_month: int | None = None) -> DataFrame:
    """Drivers of one comparison (and month), largest change first."""
    kind = "MoM" if comparison_type == "MoM" else "YoY"
    rows = drivers.filter(F.col("comparison_type") == kind)
    if year_month is not None:
        rows = rows.filter(F.col("year_month") == year_month)
    return rows.select(
        "year_month", "subcategory", "delta_revenue", "effect_volume", "effect_price", "effect_mix"
    ).orderBy(F.abs("delta_revenue").desc(), "year_month", "subcategory")


def pvm_reading(drivers: DataFrame, year_month: int, comparison_type: str = "YoY") -> DataFrame:
    """One period rounded to whole currency, ordered by the size of the change."""
    chosen = drivers.filter(
        (F.col("comparison_type") == comparison_type) & (F.col("year_month") == year_month)
    )
    return chosen.orderBy(F.abs("delta_revenue").desc(), "subcategory").select(
        "subcategory",
        F.round("delta_revenue", 0).alias("delta"),
        F.round("effect_volume", 0).alias("vol"),
        F.round("effect_price", 0).alias("preco"),
        F.round("effect_mix", 0).alias("mix"),
    )
