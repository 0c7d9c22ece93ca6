"""Refresh of what newly loaded files touch: keys are conformed again, and only folders that hold them are rewritten.

Silver remembers the bronze folders it covers, gold the silver versions; both marks are part of the
version they belong to, so a refresh cut short anywhere is continued by the next. What changed in silver is
read off two versions by comparing the folders they do not share.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom.operators.conform import conform_keyed, keep_latest, key_columns, keyed_rows
from martloom.operators.quality import marked
from martloom.plans import gold
from martloom.plans.contracts import CONTRACTS
from martloom.plans.mart import Mart
from martloom.plans.refresh import (
    ANALYTICS, FACTS, FOLDER, ORDERS_PER_FOLDER, HeldBack, gold_layout, refresh_analytic, refresh_gold, run_when_ready,
    silver_layout, silver_note,
)
from martloom.plans.silver import SPECS
from martloom.session import shuffles_released
from martloom.sinks.lake import Lake
from martloom.sinks.versions import Version, VersionedTable, value_of

STAMPS = ("_silver_loaded_at", "_gold_loaded_at")
#: Rows beyond which a load is taken as a whole: joins with its keys would shuffle all they meet, several times over.
BULK = 1 << 18
REPORT = "layer string, table_name string, outcome string, folders long, rewritten long, message string"


@dataclass(frozen=True)
class Outcome:
    """``unchanged``, ``merged`` or ``rebuilt``; folders the table has, and how many of those it had were rewritten."""

    layer: str
    table: str
    outcome: str
    folders: int
    rewritten: int


def _same(left: DataFrame, right: DataFrame, columns: Iterable[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])


def with_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is listed. NULL is a key like any other."""
    return rows.join(keys, _same(rows, keys, keys.columns), "left_semi")


def without_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    return rows.join(keys, _same(rows, keys, keys.columns), "left_anti")


def may_hold(version: Version, keys: DataFrame, range_of: str | None) -> list[str]:
    """Parts whose key range meets that of the keys; parts without a known range always."""
    if range_of is None or range_of not in keys.columns:
        return list(version.parts)
    return _in_range(version, *keys.agg(F.min(range_of), F.max(range_of)).first())


def _in_range(version: Version, low: int | None, high: int | None) -> list[str]:
    """Parts whose key range meets the given one, and parts without a known range."""
    if low is None:
        return [p for p in version.parts if p not in version.ranges]
    return [
        p for p in version.parts
        if p not in version.ranges or not (version.ranges[p][1] < low or version.ranges[p][0] > high)
    ]


def _values(rows: DataFrame, column: str) -> set[str | None]:
    return {None if r[0] is None else str(r[0]) for r in rows.select(column).distinct().collect()}  # one per folder


def replace_keys(
    stored: VersionedTable, current: Version, keys: DataFrame, rows: DataFrame, range_of: str | None, note: dict
) -> int:
    """A version in which ``rows`` stand for everything that had one of the ``keys``. Returns the parts rewritten.

    ``rows`` have all columns of the table, the partition column included. Parts that hold none of the keys and get
    no row are taken over unread.
    """
    by = current.partition_by
    rows = rows.persist()  # read for its folders and again to be written
    if by is None:
        touched = list(current.parts)
    else:
        candidates = may_hold(current, keys, range_of)
        values = _values(with_keys(stored.frame(current, candidates), keys), by) | _values(rows, by)
        touched = [p for p in current.parts if value_of(p) in values]
    rest = without_keys(stored.frame(current, touched), keys)
    made = stored.write(rest.unionByName(rows), by, range_of)
    rows.unpersist()
    stored.replace_parts(current, touched, made, note)
    return len(touched)


def changed_keys(stored: VersionedTable, before: Version, after: Version, columns: Sequence[str]) -> DataFrame:
    """Distinct ``columns`` of rows that one version has and the other has not, the time of loading aside.

    Only parts that the versions do not share are read.
    """
    gone = stored.frame(before, [p for p in before.parts if p not in after.parts])
    come = stored.frame(after, [p for p in after.parts if p not in before.parts])
    compared = [c for c in after.schema.fieldNames() if c not in (*STAMPS, FOLDER)]
    both = gone.select(*compared, F.lit(-1).alias("_side")).unionByName(come.select(*compared, F.lit(1).alias("_side")))
    differing = both.groupBy(*compared).agg(F.sum("_side").alias("_n")).filter("_n <> 0")
    return differing.select(*columns).distinct()


# silver


def merge_silver(lake: Lake, table: str) -> Outcome:
    """Bring a silver table up to the newest bronze version."""
    spec = SPECS[table]
    bronze, stored = lake.table("bronze", table), lake.table("silver", table)
    source, current = bronze.version(), stored.version()
    known = set(current.note.get("bronze", ())) if current else set()
    fresh = [p for p in source.parts if p not in known]
    if current is not None and not fresh and known <= set(source.parts):
        return Outcome("silver", table, "unchanged", len(current.parts), 0)
    note, stamp = silver_note(table, source.parts), F.current_timestamp()
    if current is None or not known <= set(source.parts):
        rows, folder, range_of = silver_layout(table, marked(conform_keyed(bronze.frame(source), spec, stamp), spec.rules))
        made = stored.replace(rows, folder, range_of, note)
        return Outcome("silver", table, "rebuilt", len(made.parts), len(current.parts) if current else 0)
    if bronze.frame(source, fresh).count() > BULK:  # from the footers of the files
        rewritten = _merge_bulk(table, stored, current, keyed_rows(bronze.frame(source, fresh), spec), stamp, note)
        return Outcome("silver", table, "merged", len(stored.version().parts), rewritten)
    key = key_columns(spec)
    arrived = conform_keyed(bronze.frame(source, fresh), spec, stamp)
    arrived, folder, range_of = silver_layout(table, marked(arrived, spec.rules))
    keys = arrived.select(*key).distinct().persist()
    held = with_keys(stored.frame(current, may_hold(current, keys, range_of)), keys)
    latest = keep_latest(held.unionByName(arrived), key, "_source_id")
    rewritten = replace_keys(stored, current, keys, latest, range_of, note)
    keys.unpersist()
    return Outcome("silver", table, "merged", len(stored.version().parts), rewritten)


def _merge_bulk(table: str, stored: VersionedTable, current: Version, arrived: DataFrame, stamp: Column, note: dict) -> int:
    """Rows that arrived ranked together with those of the folders they may touch, in one shuffle. Returns the parts rewritten.

    A folder may be touched if its key range meets that of the arrived rows or one of them belongs there; a row whose key
    did not arrive is alone with it and stays as it is.
    """
    spec = SPECS[table]
    placed, folder, range_of = silver_layout(table, arrived)
    touched = list(current.parts)
    if folder is not None:
        span = placed.agg(
            F.min(range_of).alias("low"), F.max(range_of).alias("high"), F.collect_set(folder).alias("folders"),
            F.bool_or(F.col(folder).isNull()).alias("unplaced"),
        ).first()
        values = {str(v) for v in span.folders} | ({None} if span.unplaced else set())
        in_range = set(_in_range(current, span.low, span.high))
        touched = [p for p in touched if p in in_range or value_of(p) in values]
    held = stored.frame(current, touched).drop(*(c for c in ("_kept", folder) if c))
    both = held.unionByName(arrived.withColumn("_silver_loaded_at", stamp))
    latest = keep_latest(both, key_columns(spec), "_source_id")
    made = stored.write(silver_layout(table, marked(latest, spec.rules))[0], folder, range_of)
    stored.replace_parts(current, touched, made, note)
    return len(touched)


# gold


def _replaced_in_bulk(lake: Lake, since: dict[str, Version], now: dict[str, Version]) -> bool:
    """Whether no silver folder is left as it was, and there are many rows: to look for those that differ would shuffle
    both versions, to compose the table shuffles one."""
    if any(set(since[t].parts) & set(now[t].parts) for t in now):
        return False
    return sum(lake.table("silver", t).frame(now[t]).count() for t in now) > BULK


def _order_keys(lake: Lake, since: dict[str, Version], now: dict[str, Version]) -> DataFrame:
    """Orders whose header or lines changed, before or after."""
    return reduce(
        DataFrame.unionByName,
        [changed_keys(lake.table("silver", t), since[t], now[t], ["sales_header_key"]) for t in ("sales_details", "sales_header")],
    ).distinct()


def _shown(lake: Lake, table: str, version: Version, parts: Iterable[str]) -> DataFrame:
    return lake.table("silver", table).frame(version, parts).filter(version.note["shown"]).drop(*version.note["hidden"])


def _sales_of_orders(lake: Lake, now: dict[str, Version], orders: DataFrame) -> DataFrame:
    """The sales fact of some orders: lines from the folders of these orders, headers by their key ranges."""
    folder = F.floor(F.col("sales_header_key") / ORDERS_PER_FOLDER).cast("int").alias(FOLDER)
    folders = _values(orders.select(folder), FOLDER)
    lines, headers = now["sales_details"], now["sales_header"]
    details = _shown(lake, "sales_details", lines, [p for p in lines.parts if value_of(p) in folders])
    header = _shown(lake, "sales_header", headers, may_hold(headers, orders, "sales_header_key"))
    return gold.fct_sales_details(with_keys(details, orders), with_keys(header, orders), F.current_timestamp())


def merge_gold(lake: Lake, table: str) -> Outcome:
    """Bring a gold table up to the newest versions of its silver tables. Dimensions are small and made anew."""
    stored, sources = lake.table("gold", table), Mart.sources(table)
    current = stored.version()
    now = {t: lake.table("silver", t).version() for t in sources}
    seen = current.note.get("silver", {}) if current else {}
    if current is not None and seen == {t: v.number for t, v in now.items()}:
        return Outcome("gold", table, "unchanged", len(current.parts), 0)
    readable = {t: set(lake.table("silver", t).versions()) for t in sources}
    if table not in FACTS or current is None or any(seen.get(t) not in readable[t] for t in sources):
        refresh_gold(lake, [table])
        return Outcome("gold", table, "rebuilt", len(stored.version().parts), len(current.parts) if current else 0)
    since = {t: lake.table("silver", t).version(seen[t]) for t in sources}
    if _replaced_in_bulk(lake, since, now):
        refresh_gold(lake, [table])
        return Outcome("gold", table, "rebuilt", len(stored.version().parts), len(current.parts))
    layout = FACTS[table]
    note = {"silver": {t: v.number for t, v in now.items()}}
    if table == "fct_sales_details":
        keys = _order_keys(lake, since, now).persist()
        rows = _sales_of_orders(lake, now, keys)
    else:
        (source,) = sources
        keys = changed_keys(lake.table("silver", source), since[source], now[source], layout.key).persist()
        come = [p for p in now[source].parts if p not in since[source].parts]
        rows = gold.projection(table, with_keys(_shown(lake, source, now[source], come), keys), F.current_timestamp())
    rewritten = replace_keys(stored, current, keys, gold_layout(table, rows)[0], layout.range_of, note)
    keys.unpersist()
    return Outcome("gold", table, "merged", len(stored.version().parts), rewritten)


def refresh_incrementally(lake: Lake, analytics: bool = True) -> DataFrame:
    """Silver, gold and analytic tables up to what bronze holds now; returns a row per table.

    The result equals ``refresh``, the times of loading aside. A table whose bronze rows were replaced, or whose
    marks name a version that has expired, is rebuilt, and so is a large fact of which no silver folder is left as it was. A table begins as soon as those it reads are done. One that
    fails stops only the tables made of it: the report has it as ``failed`` with the message and these as ``held back``;
    the next run takes up what is missing, since every table knows what it covers. ``completed`` makes such a report an error.
    """
    steps: dict[str, tuple[list[str], object]] = {f"silver.{t}": ([], lambda t=t: merge_silver(lake, t)) for t in SPECS}
    for t in CONTRACTS:
        steps[f"gold.{t}"] = ([f"silver.{s}" for s in Mart.sources(t)], lambda t=t: merge_gold(lake, t))
    for t, sources in ANALYTICS.items() if analytics else ():
        after = [f"ml.{s}" if s in ANALYTICS else f"gold.{s}" for s in sources]
        steps[f"ml.{t}"] = (after, lambda t=t: _merge_analytic(lake, t))
    rows = []
    with shuffles_released(lake.spark):
        results = run_when_ready(steps)
    for name, result in results.items():
        layer, table = name.split(".")
        if isinstance(result, Exception):
            outcome = "held back" if isinstance(result, HeldBack) else "failed"
            rows.append((layer, table, outcome, None, None, f"{type(result).__name__}: {result}".splitlines()[0][:500]))
        else:
            rows.append((layer, table, result.outcome, result.folders, result.rewritten, None))
    return lake.spark.createDataFrame(sorted(rows, key=lambda r: r[:2]), REPORT)


class Incomplete(RuntimeError):
    """A refresh after which tables lack some of what was loaded."""


def completed(report: DataFrame) -> DataFrame:
    """The report of a refresh, or ``Incomplete`` if a table failed or was held back: its rows are those of an earlier load."""
    lacking = [r for r in report.collect() if r.outcome in ("failed", "held back")]
    if lacking:
        raise Incomplete("; ".join(f"{r.layer}.{r.table_name} {r.outcome}: {r.message}" for r in lacking))
    return report


def _merge_analytic(lake: Lake, name: str) -> Outcome:
    """An analytic table made anew if what it reads has changed since."""
    read = {t: lake.table("semantic" if t in ANALYTICS else "gold", t).version().number for t in ANALYTICS[name]}
    layer = "semantic" if name == "dim_customer_rfm" else "ml"
    mark = lake.table("_ops", f"analytic_{name}")
    seen = mark.version()
    if seen is not None and seen.note.get("read") == read and lake.exists(layer, name):
        return Outcome("ml", name, "unchanged", 1, 0)
    refresh_analytic(lake, name)
    mark.commit(seen, Version(-1, StructType([]), None, (), {}, {"read": read}))
    return Outcome("ml", name, "rebuilt", 1, 1)
