"""Stored refresh of the whole mart: bronze to silver to gold to analytic tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.conform import key_columns, observed_silver
from martloom.plans import forecast, growth, rfm
from martloom.plans.contracts import CONTRACTS
from martloom.plans.mart import Mart
from martloom.plans.silver import SPECS
from martloom.session import shuffles_released
from martloom.sinks.lake import Lake

@dataclass(frozen=True)
class FactLayout:
    """A stored fact: its folder column and how a row gives it, the key whose range each folder knows, and the
    columns by which a refresh tells what changed."""

    folder: str
    value: Callable[[], Column]
    range_of: str
    key: tuple[str, ...]


# Facts are stored by the year that questions name: of the order for sales and returns, of the entry for
# the ledger. The flat views take the year from this column, so a filter on it reads one folder.
FACTS = {
    "fct_sales_details": FactLayout("order_year", lambda: F.year("order_date"), "sales_header_key", ("sales_header_key",)),
    "fct_sales_returns": FactLayout("order_year", lambda: F.year("order_date"), "return_key", ("return_key",)),
    "fct_finance": FactLayout("transaction_year", lambda: F.year("transaction_date"), "finance_key", ("finance_key",)),
    "fct_product_cost_history": FactLayout(
        "cost_year", lambda: F.col("year"), "product_key", ("product_key", "country_code", "year", "month_no")
    ),
}
#: Orders whose lines share a silver folder.
ORDERS_PER_FOLDER = 1 << 22
FOLDER = "_folder"
#: How silver facts are laid out: a folder number from the row, and the key whose range each folder knows.
SILVER_FOLDERS: dict[str, tuple[Callable[[], Column], str]] = {
    "sales_header": (lambda: F.year("order_date"), "sales_header_key"),
    "sales_details": (lambda: F.floor(F.col("sales_header_key") / ORDERS_PER_FOLDER), "sales_details_key"),
    "sales_returns": (lambda: F.year("order_date"), "return_key"),
    "finance": (lambda: F.year("transaction_date"), "finance_key"),
    "product_cost_history": (lambda: F.col("year"), "product_key"),
}
PARALLEL_TABLES = 4


def each_of(tables: Iterable[str], refresh_one: Callable[[str], object]) -> None:
    """Independent tables side by side, so small ones fill the gaps large ones leave."""
    with ThreadPoolExecutor(max_workers=PARALLEL_TABLES) as pool:
        list(pool.map(refresh_one, tables))


def run_when_ready(
    steps: Mapping[str, tuple[Iterable[str], Callable[[], object]]], parallel: int = PARALLEL_TABLES
) -> dict[str, object]:
    """Run each step once those it names are done, several side by side; results by name.

    A step that fails has its exception as its result, and so has every step after it, which never runs;
    all others finish.
    """
    results: dict[str, object] = {}
    waiting = {name: set(after) for name, (after, _) in steps.items()}
    unknown = set().union(*waiting.values()) - set(steps) if waiting else set()
    if unknown:
        raise ValueError(f"no step is called {', '.join(sorted(unknown))}")
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        running: dict[Future, str] = {}
        while waiting or running:
            for name in [n for n, after in waiting.items() if after <= set(results)]:
                faults = [results[a] for a in sorted(waiting.pop(name)) if isinstance(results[a], Exception)]
                if faults:
                    results[name] = HeldBack(str(faults[0]))
                else:
                    running[pool.submit(steps[name][1])] = name
            if not running and waiting and not any(after <= set(results) for after in waiting.values()):
                raise ValueError(f"steps wait for each other: {', '.join(sorted(waiting))}")
            done, _ = wait(running, return_when=FIRST_COMPLETED) if running else ((), ())
            for future in done:
                fault = future.exception()
                results[running.pop(future)] = future.result() if fault is None else fault
    return results


class HeldBack(RuntimeError):
    """A step that did not run because one before it failed."""


SILVER_REPORT = "table_name string, kind string, name string, action string, n long"


def silver_layout(table: str, rows: DataFrame) -> tuple[DataFrame, str | None, str | None]:
    """Rows with their folder, and the names of the folder and range columns (None for small tables)."""
    if table not in SILVER_FOLDERS:
        return rows, None, None
    folder, range_of = SILVER_FOLDERS[table]
    return rows.withColumn(FOLDER, folder().cast("int")), FOLDER, range_of


def silver_note(table: str, bronze_parts: Iterable[str]) -> dict:
    """What a silver version remembers: the bronze folders it covers, and which of its rows and columns are shown.

    Rows that a rule drops stay in the table, not shown: a later load may bring an older version of them.
    """
    raw = [c for c in key_columns(SPECS[table]) if c.startswith("_raw_")]
    return {"bronze": list(bronze_parts), "shown": "_kept", "hidden": ["_kept", FOLDER, *raw]}


def refresh_silver(lake: Lake) -> DataFrame:
    """Store silver, and return and store what was counted on the way: rows read and conformed, values
    that could not be read, rows that break each rule."""
    counted: list[tuple[str, str, str, str | None, int]] = []

    def one(table: str) -> None:
        spec, bronze = SPECS[table], lake.table("bronze", table)
        version = bronze.version()
        rows, read, checked = observed_silver(bronze.frame(version), spec, F.current_timestamp())
        rows, folder, range_of = silver_layout(table, rows)
        lake.table("silver", table).replace(rows, folder, range_of, silver_note(table, version.parts))
        actions = {r.name: r.action for r in spec.rules}
        seen, outcome = dict(read.get), dict(checked.get)
        counted.append((table, "rows", "read", None, seen.pop("_rows")))
        counted.append((table, "rows", "conformed", None, outcome.pop("rows")))
        counted.extend((table, "unreadable", name, None, n) for name, n in seen.items())
        counted.extend((table, "violated", name, actions[name], n) for name, n in outcome.items())

    each_of(SPECS, one)
    report = lake.spark.createDataFrame(sorted(counted, key=lambda r: r[:3]), SILVER_REPORT).coalesce(1)
    return lake.replace(report, "_ops", "silver_report")


def gold_layout(table: str, rows: DataFrame) -> tuple[DataFrame, str | None, str | None]:
    if table not in FACTS:
        return rows, None, None
    layout = FACTS[table]
    return rows.withColumn(layout.folder, layout.value().cast("int")), layout.folder, layout.range_of


def refresh_gold(lake: Lake, tables: Iterable[str] = tuple(CONTRACTS)) -> None:
    """Store gold tables as a whole, each from one version of silver that it remembers."""
    tables = list(tables)
    versions = {s: lake.table("silver", s).version().number for s in {s for t in tables for s in Mart.sources(t)}}
    mart = Mart(lambda t: lake.read("silver", t, versions[t]), loaded_at=F.current_timestamp())

    def one(table: str) -> None:
        rows, year, range_of = gold_layout(table, mart.gold(table))
        lake.table("gold", table).replace(rows, year, range_of, {"silver": {t: versions[t] for t in mart.sources(table)}})

    each_of(tables, one)


def register_gold(lake: Lake) -> None:
    """Name the stored gold tables in the catalog with comments and governance tags."""
    for table, contract in CONTRACTS.items():
        lake.register("gold", table, contract.comment, contract.tags())


def stored_mart(lake: Lake) -> Mart:
    return Mart(
        lambda t: lake.read("silver", t),
        gold=lambda t: lake.read("gold", t),
    )


#: What each analytic table is made of.
ANALYTICS = {
    "dim_customer_rfm": ("fct_sales_details",),
    "reco_customer_actions": ("dim_customer_rfm",),
    "pvm_drivers": ("fct_sales_details", "dim_product"),
    "forecast_sales": ("fct_sales_details",),
}


def analytic_tables(mart: Mart) -> dict[str, DataFrame]:
    """The analytic tables by name, composed from gold."""
    sales = mart.gold("fct_sales_details")
    scores = rfm.customer_rfm(sales)
    return {
        "dim_customer_rfm": scores,
        "reco_customer_actions": rfm.customer_actions(scores),
        "pvm_drivers": growth.price_volume_mix(sales, mart.gold("dim_product")),
        "forecast_sales": forecast.forecast(forecast.monthly_history(sales)).drop("y"),
    }


def refresh_analytic(lake: Lake, name: str) -> None:
    """Store one analytic table; the actions read the stored scores."""
    if name == "dim_customer_rfm":
        lake.replace(rfm.customer_rfm(stored_mart(lake).gold("fct_sales_details")), "semantic", name)
        return
    if name == "reco_customer_actions":
        rows = rfm.customer_actions(lake.read("semantic", "dim_customer_rfm"))
    else:
        rows = analytic_tables(stored_mart(lake))[name]
    lake.replace(rows.withColumn("_generated_at", F.current_timestamp()), "ml", name)


def refresh_analytics(lake: Lake) -> None:
    """Every analytic table once what it reads is stored."""
    steps = {n: ([a for a in after if a in ANALYTICS], lambda n=n: refresh_analytic(lake, n)) for n, after in ANALYTICS.items()}
    for fault in run_when_ready(steps).values():
        if isinstance(fault, Exception):
            raise fault


def refresh(lake: Lake) -> DataFrame:
    """Everything from bronze on; returns the report of ``refresh_silver``."""
    with shuffles_released(lake.spark):
        report = refresh_silver(lake)
        refresh_gold(lake)
        refresh_analytics(lake)
    return report
