"""Control-driven ingestion: landing folders into the bronze layer."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from martloom.sinks.lake import BRONZE, Lake
from martloom.sinks.versions import Version
from martloom.sources.landing import listed_files
from martloom.streaming.drift import RESCUED, alike, landed_rows, remembered
from martloom.streaming.file_stream import load_new_files, store_schema, stored_schema

REPORT_SCHEMA = (
    "source_table string, load_type string, ingestion_mode string, status string, "
    "rows_before long, rows_after long, message string, rescued_rows long"
)


class UnknownHistory(RuntimeError):
    """A table holds rows, and nothing tells from which landed files they came."""


def full_load(lake: Lake, table: str, source: str) -> None:
    """Replace the table by everything in its landing folder, and remember the files that brought it.

    The rows and the list of their files are written first; the new version then makes both count at once. An
    incremental load that follows adds only files that land later.
    """
    names = [r["file"] for r in listed_files(lake.spark, source).orderBy("file").collect()]
    if not names:
        raise FileNotFoundError(f"no Parquet file in {source}")
    runs = alike(lake.spark, names)
    schema = remembered(None, runs)
    landed = landed_rows(lake.spark, runs, schema)
    load, stored = f"full-{uuid4().hex[:12]}", lake.table(BRONZE, table)
    parent = stored.version()
    made = stored.write(landed, folder=load)
    files = lake.spark.createDataFrame([(f,) for f in names], "file string")
    files.coalesce(1).write.mode("overwrite").parquet(f"{lake.ledger(table)}/load={load}")
    store_schema(lake.spark, lake.schema_location(table), schema)
    stored.commit(parent, Version(-1, schema, None, made.parts, {}, {"loads": True, "generation": load}))


def reload(lake: Lake, table: str, source: str) -> int:
    """Load in full and count."""
    full_load(lake, table, source)
    return stored_rows(lake, table)


def _unseen_files(lake: Lake, table: str, source: str) -> list[str]:
    """Landed files that no load of the table's version lists. Only their names come to the driver."""
    landed = listed_files(lake.spark, source).select("file")
    if lake.has_load_history(table):
        known = lake.spark.read.schema("file string, load string").parquet(lake.ledger(table))
        landed = landed.join(known.filter(F.col("load").isin(*lake.loads(table))), "file", "left_anti")
    return [r["file"] for r in landed.orderBy("file").collect()]


def _incremental(lake: Lake, table: str, source: str, reset: bool) -> tuple[int, int]:
    """Rows added, and rows among them with a rescued value."""
    if lake.exists(BRONZE, table) and not lake.has_load_history(table):
        if not reset:
            raise UnknownHistory(
                f"{table} has rows but neither a checkpoint nor a ledger of loaded files; "
                "reset=True replaces it by what its landing folder holds"
            )
        return reload(lake, table, source), rescued_rows(lake, table)
    unseen = _unseen_files(lake, table, source)
    if not unseen:
        return 0, 0
    location = lake.schema_location(table)
    stored = stored_schema(lake.spark, location)
    merged = remembered(stored, alike(lake.spark, unseen))
    if merged != stored:
        store_schema(lake.spark, location, merged)
    return load_new_files(
        lake.spark, source, lake.table(BRONZE, table), lake.checkpoint(table), lake.ledger(table), merged
    )


def copy_into(lake: Lake, table: str, source: str, reset: bool = False) -> int:
    """Add landed files not loaded before, in the schema remembered between runs. Returns the rows added.

    New columns are added, types grow, and values that fit no longer go to ``_rescued`` with the name of their
    file. Nothing is ever deleted: a table whose history is unknown raises ``UnknownHistory`` unless ``reset``.
    """
    return _incremental(lake, table, source, reset)[0]


#: The second ingestion mode differs in its name only.
auto_load = copy_into


def rescued_rows(lake: Lake, table: str) -> int:
    """Rows of a bronze table with a value that did not fit its column."""
    rows = lake.read(BRONZE, table)
    return rows.filter(F.col(RESCUED).isNotNull()).count() if RESCUED in rows.columns else 0


def stored_rows(lake: Lake, table: str) -> int:
    """Row count of a bronze table (Parquet footers only), 0 before its first load."""
    return lake.read(BRONZE, table).count() if lake.exists(BRONZE, table) else 0


def _full(lake: Lake, table: str, source: str) -> tuple[int, int]:
    return reload(lake, table, source), rescued_rows(lake, table)


def _loader(row: Row) -> Callable[[Lake, str, str], tuple[int, int]] | None:
    if row["load_type"] == "full":
        return _full
    if row["load_type"] == "incremental" and row["ingestion_mode"] in ("copy_into", "autoloader"):
        return lambda lake, table, source: _incremental(lake, table, source, reset=False)
    return None


def ingest(
    lake: Lake, control: DataFrame, landing: Callable[[str], str], parallel_tables: int = 4
) -> DataFrame:
    """Load every active control row and report on each: ``loaded``, ``skipped`` (unknown settings) or
    ``failed`` with the message; a table that fails stops no other. Rows of which a value was rescued are counted.

    Only the control rows (one per source table) come to the driver. Independent tables load
    side by side so a small one never waits for a large one.
    """

    def load(row: Row) -> tuple[str, str, str, str, int | None, int | None, str | None, int | None]:
        table, loader = row["source_table"], _loader(row)
        status, message, before, after, rescued = "skipped", None, None, None, None
        try:
            before = after = stored_rows(lake, table)
            if loader is not None:
                added, rescued = loader(lake, table, landing(row["target_folder"]))
                after = added if loader is _full else before + added
                status = "loaded"
        except Exception as fault:  # reported below, table by table
            status, message = "failed", f"{type(fault).__name__}: {fault}".splitlines()[0][:500]
        return (table, row["load_type"], row["ingestion_mode"], status, before, after, message, rescued)

    rows = control.filter("is_active").collect()
    with ThreadPoolExecutor(max_workers=parallel_tables) as pool:
        report = list(pool.map(load, rows))
    return lake.spark.createDataFrame(report, REPORT_SCHEMA)
