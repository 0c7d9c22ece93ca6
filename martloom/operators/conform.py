"""Bronze to silver: typed, renamed, trimmed columns and one row per business key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from martloom.functions import text
from martloom.operators.quality import Expectation, enforce, observed

READERS: dict[str, Callable[[Column], Column]] = {
    "key": lambda c: c.try_cast("bigint"),
    "int": lambda c: c.try_cast("int"),
    "text": text.clean,
    "lower": text.clean_lower,
    "money": text.parse_decimal,
    "revenue": lambda c: text.parse_decimal(c, "decimal(18,2)"),
    "date": text.parse_date,
}


@dataclass(frozen=True)
class Field:
    name: str
    source: str
    reads_as: str

    def column(self) -> Column:
        return READERS[self.reads_as](F.col(f"`{self.source}`")).alias(self.name)


@dataclass(frozen=True)
class ConformSpec:
    table: str
    fields: tuple[Field, ...]
    dedup_key: tuple[str, ...]
    rules: tuple[Expectation, ...] = ()
    version: str = "id"

    def parsed_fields(self) -> tuple[Field, ...]:
        """Fields where reading can fail on non-empty text."""
        return tuple(f for f in self.fields if f.reads_as not in ("text", "lower"))


def keep_latest(df: DataFrame, key: tuple[str, ...], version: str, *tiebreak: str) -> DataFrame:
    """One row per key, the highest version winning.

    The rank filter is pushed below the shuffle (window group limit), so each map task ships at
    most one row per key however many copies of that key it holds.
    """
    order = [F.col(f"`{c}`").desc_nulls_last() for c in (version, *tiebreak)]
    ranked = Window.partitionBy(*[F.col(f"`{c}`") for c in key]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def _key_fields(spec: ConformSpec) -> list[Field]:
    return [f for f in spec.fields if f.source in spec.dedup_key]


def key_columns(spec: ConformSpec) -> tuple[str, ...]:
    """Columns that tell the rows of ``conform_keyed`` apart: keys, and the raw text of unreadable ones."""
    keys = _key_fields(spec)
    return (*(f.name for f in keys), *(f"_raw_{f.name}" for f in keys))


def conform_keyed(bronze: DataFrame, spec: ConformSpec, loaded_at: Column | None = None) -> DataFrame:
    """As ``conform``, still with the raw text of keys that could not be read (``_raw_*``, else NULL).

    Only keys and versions are read before rows are ranked; the other fields are parsed on the rows that are left.
    """
    keys = _key_fields(spec)
    raw = {f"_raw_{f.name}": F.when(f.column().isNull(), F.col(f"`{f.source}`")).cast("string") for f in keys}
    named = {f"_key_{f.name}": f.column() for f in keys}
    others = [f for f in spec.fields if f not in keys]
    rows = bronze.select(
        *[F.col(f"`{s}`") for s in dict.fromkeys(f.source for f in others)],
        F.col(spec.version).try_cast("bigint").alias("_source_id"),
        *[c.alias(n) for n, c in (named | raw).items()],
    )
    latest = keep_latest(rows, (*named, *raw), "_source_id").select(
        *[F.col(f"_key_{f.name}").alias(f.name) if f in keys else f.column() for f in spec.fields], "_source_id", *raw
    )
    return latest if loaded_at is None else latest.withColumn("_silver_loaded_at", loaded_at)


def keyed_rows(bronze: DataFrame, spec: ConformSpec, watch: Observation | None = None) -> DataFrame:
    """Every version of every row as typed fields, with ``_source_id`` and ``_raw_*`` as in ``conform_keyed``.

    For rows that are shuffled to be stored: a date or an amount takes a third of the bytes of its text on the way.
    ``watch`` counts rows and values that could not be read, from the same values.
    """
    keys = _key_fields(spec)
    named = [f.name for f in spec.fields]
    texts = {f"_text_{s}": F.col(f"`{s}`") for s in dict.fromkeys(f.source for f in (*spec.parsed_fields(), *keys))}
    rows = bronze.select(
        *[f.column() for f in spec.fields],
        F.col(spec.version).try_cast("bigint").alias("_source_id"),
        *[c.alias(n) for n, c in texts.items()],
    )
    if watch is not None:
        failed = {f.name: F.count_if(text.parse_failed(F.col(f"_text_{f.source}"), F.col(f.name))) for f in spec.parsed_fields()}
        rows = rows.observe(watch, F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in failed.items()])
    raw = [
        F.when(F.col(f.name).isNull(), F.col(f"_text_{f.source}")).cast("string").alias(f"_raw_{f.name}") for f in keys
    ]
    return rows.select(*named, "_source_id", *raw)


def conform(bronze: DataFrame, spec: ConformSpec, loaded_at: Column | None = None) -> DataFrame:
    """Typed silver rows before the rules are applied, one per key as silver holds it.

    Keys and versions are compared after conforming, so padding makes no second row and version 10
    beats 9 when they arrive as text. A key that cannot be read stays apart by its raw text, for the
    rules to drop and count.
    """
    return conform_keyed(bronze, spec, loaded_at).drop(*[f"_raw_{f.name}" for f in _key_fields(spec)])


def to_silver(bronze: DataFrame, spec: ConformSpec, loaded_at: Column | None = None) -> DataFrame:
    return enforce(conform(bronze, spec, loaded_at), spec.rules)


def _unreadable(spec: ConformSpec) -> dict[str, Column]:
    return {
        f.name: F.count_if(text.parse_failed(F.col(f"`{f.source}`"), READERS[f.reads_as](F.col(f"`{f.source}`"))))
        for f in spec.parsed_fields()
    }


def observed_silver(
    bronze: DataFrame, spec: ConformSpec, loaded_at: Column | None = None
) -> tuple[DataFrame, Observation, Observation]:
    """Keyed rows marked by the rules, with unreadable values per field and rule outcomes counted while they are written."""
    read = Observation(f"read_{spec.table}_{uuid4().hex}")
    latest = keep_latest(keyed_rows(bronze, spec, read), key_columns(spec), "_source_id")
    if loaded_at is not None:
        latest = latest.withColumn("_silver_loaded_at", loaded_at)
    rows, checked = observed(latest, spec.table, spec.rules)
    return rows, read, checked


def parse_failures(bronze: DataFrame, spec: ConformSpec) -> DataFrame:
    """Count, per field, the values that were present but could not be read (one pass)."""
    fields = _unreadable(spec)
    counts = bronze.agg(*[c.alias(n) for n, c in fields.items()])
    return counts.unpivot([], list(fields), "column_name", "unreadable").select(
        F.lit(spec.table).alias("table_name"), "column_name", "unreadable"
    )
