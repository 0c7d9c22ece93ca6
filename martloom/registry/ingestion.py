"""Landing scans, control tables, incremental loads."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.checks import key_profile
from martloom.registry.core import Context, query
from martloom.session import scratch_dir
from martloom.sinks.lake import Lake
from martloom.sources import landing
from martloom.sources.ingest import BRONZE, copy_into, ingest
from martloom.streaming.file_stream import append_available, file_stream

# What the listing of the sample folder has to find, and the column a table is watched by where it has one.
LANDED = (
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders",
    "pages", "part", "region", "supplier",
)
WATCHED = {"orders": ("o_orderdate", "updated_at"), "lineitem": ("l_shipdate", "modified_on")}


def _landed(c: Context) -> dict[str, DataFrame]:
    tables = {}
    for name in landing.landed_tables(c.spark, c.sample.path("*").rsplit("/", 1)[0]):
        df = c.sample.read(name)
        tables[name] = df.withColumnRenamed(*WATCHED[name]) if name in WATCHED else df
    return tables


@query(
    "scan_parquet",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_quantity > 45",
)
def scan_parquet(c: Context):
    lines = landing.scan_parquet(c.spark, c.sample.path("lineitem"))
    return lines.filter("l_quantity > 45").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query(
    "landing_files",
    " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file_name, count(*) AS file_rows, count(*) > 0 AS has_bytes FROM {t}" for t in LANDED
    ),
)
def landing_files(c: Context):
    root = c.sample.path("*").rsplit("/", 1)[0]
    listings = [landing.landing_files(c.spark, f"{root}/{name}.parquet") for name in landing.landed_tables(c.spark, root)]
    return reduce(DataFrame.unionByName, listings).select(
        "file_name", "file_rows", (F.col("file_bytes") > 0).alias("has_bytes")
    )


@query(
    "control_watermark",
    " UNION ALL ".join(
        f"SELECT 'landing' AS table_schema, '{t}' AS table_name, '{w[1]}' AS watermark_column,"
        f" count(*) AS source_rows, CAST(max({w[0]}) AS VARCHAR) AS high_water_mark FROM {t}"
        for t, w in WATCHED.items()
    ),
)
def control_watermark(c: Context):
    tables = _landed(c)
    found = landing.watermark_candidates(landing.discover_columns(c.spark, tables))
    state = landing.load_state({t: tables[t] for t in WATCHED}, {t: w[1] for t, w in WATCHED.items()})
    return found.join(state.withColumnRenamed("source_table", "table_name"), "table_name").select(
        "table_schema", "table_name", "watermark_column", "source_rows", "high_water_mark"
    )


def _control_sql() -> str:
    parts = []
    for t in LANDED:
        name, mark = WATCHED.get(t, (None, None))
        load = "incremental" if name else "full"
        column = f"'{mark}'" if mark else "CAST(NULL AS VARCHAR)"
        high = f"CAST(max({name}) AS VARCHAR)" if name else "CAST(NULL AS VARCHAR)"
        parts.append(
            f"SELECT 'landing' AS source_schema, '{t}' AS source_table, '{t}' AS target_folder, '{load}' AS load_type,"
            f" {column} AS watermark_column, 'copy_into' AS ingestion_mode, true AS is_active,"
            f" count(*) AS source_rows, {high} AS high_water_mark FROM {t}"
        )
    return " UNION ALL ".join(parts)


def _control(c: Context) -> DataFrame:
    tables = _landed(c)
    control = landing.control_table(landing.discover_columns(c.spark, tables))
    state = landing.load_state(tables, {t: w[1] for t, w in WATCHED.items()})
    return control.join(state, "source_table").select(
        "source_schema", "source_table", "target_folder", "load_type", "watermark_column",
        "ingestion_mode", "is_active", "source_rows", "high_water_mark",
    )


@query("control_table", _control_sql())
def control_table(c: Context):
    return _control(c)


@query(
    "discover_control",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS source_rows FROM {t}" for t in LANDED),
)
def discover_control(c: Context):
    tables = _landed(c)
    columns = landing.discover_columns(c.spark, tables)
    state = landing.load_state(tables, {})
    return (
        columns.select("table_name").distinct()
        .join(state.withColumnRenamed("source_table", "table_name"), "table_name")
        .select("table_name", "source_rows")
    )


@query(
    "control_json",
    """SELECT source_table, '{"source_schema":"landing","source_table":"' || source_table || '","target_folder":"' || source_table
         || '","load_type":"' || load_type || '"' || coalesce(',"watermark_column":"' || watermark_column || '"', '')
         || ',"ingestion_mode":"copy_into","is_active":true,"source_rows":' || source_rows
         || coalesce(',"high_water_mark":"' || high_water_mark || '"', '') || '}' AS document FROM (""" + _control_sql() + ")",
)
def control_json(c: Context):
    return landing.control_json(_control(c))


@query(
    "key_profile",
    "SELECT count(*) AS total, count(DISTINCT l_orderkey) AS distintos FROM lineitem",
)
def profile_of_key(c: Context):
    return key_profile(c.sample.read("lineitem"), "l_orderkey")


@query(
    "incremental_watermark",
    "SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_totalprice FROM orders"
    " WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderstatus = 'F')",
)
def incremental_watermark(c: Context):
    """A first run loads the finished orders and stores its mark; the next takes what came after it."""
    orders, location = c.sample.read("orders"), scratch_dir(c.spark, "marks")
    landing.store_marks(landing.load_state({"orders": orders.filter("o_orderstatus = 'F'")}, {"orders": "o_orderdate"}), location)
    changed = landing.rows_since(orders, "o_orderdate", landing.stored_mark(c.spark, location, "orders"))
    return changed.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_totalprice")


@query("preview_rows", "SELECT count(*) AS shown FROM (SELECT 1 FROM orders LIMIT 10)")
def preview_rows(c: Context):
    """The limit is the feature: a preview shows ten rows of any table."""
    return landing.preview(c.sample.read("orders")).agg(F.count(F.lit(1)).alias("shown"))


@query(
    "stream_append_available_now",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1",
)
def stream_append_available_now(c: Context):
    """Events appended by a file stream that stops when it has caught up, read back and counted."""
    root = scratch_dir(c.spark, "stream")
    source = c.sample.landing("events")
    stream = file_stream(c.spark, source, c.spark.read.parquet(source).schema)
    append_available(stream, f"{root}/table", f"{root}/checkpoint")
    loaded = c.spark.read.parquet(f"{root}/table")
    return loaded.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "copy_into_idempotent",
    "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1",
)
def copy_into_idempotent(c: Context):
    """Loading the same folder twice leaves every row once."""
    lake = Lake(c.spark, scratch_dir(c.spark, "copy"))
    for _ in range(2):
        copy_into(lake, "orders", c.sample.landing("orders"))
    return lake.read(BRONZE, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


# Loads of the report: every kind, two settings nothing handles, and a table that never landed.
LOADS = (
    ("nation", "full", "copy_into", True),
    ("orders", "incremental", "copy_into", True),
    ("customer", "incremental", "autoloader", True),
    ("part", "snapshot", "copy_into", True),
    ("supplier", "incremental", "ftp", True),
    ("unlanded", "full", "copy_into", True),
    ("region", "full", "copy_into", False),
)


@query(
    "ingest_report",
    " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, '{load}' AS load_type, '{mode}' AS ingestion_mode, '{status}' AS status,"
        f" CAST(0 AS BIGINT) AS rows_before, {rows} AS rows_after, false AS has_message, CAST({rescued} AS BIGINT) AS rescued_rows FROM {t}"
        for t, load, mode, status, rows, rescued in (
            ("nation", "full", "copy_into", "loaded", "count(*)", "0"),
            ("orders", "incremental", "copy_into", "loaded", "count(*)", "0"),
            ("customer", "incremental", "autoloader", "loaded", "count(*)", "0"),
            ("part", "snapshot", "copy_into", "skipped", "count(*) * 0", "NULL"),
            ("supplier", "incremental", "ftp", "skipped", "count(*) * 0", "NULL"),
        )
    ) + " UNION ALL SELECT 'unlanded', 'full', 'copy_into', 'failed', 0, 0, true, NULL",
)
def ingest_report(c: Context):
    control = c.spark.createDataFrame(
        [(t, t, load, mode, active) for t, load, mode, active in LOADS],
        "source_table string, target_folder string, load_type string, ingestion_mode string, is_active boolean",
    )
    report = ingest(Lake(c.spark, scratch_dir(c.spark, "ingest")), control, c.sample.landing)
    return report.withColumn("message", F.col("message").isNotNull()).withColumnRenamed("message", "has_message")


@query(
    "rescued_drift",
    "SELECT o_orderstatus, count(*) AS n, sum(CASE WHEN o_orderpriority LIKE '1%' THEN NULL ELSE o_custkey END)::BIGINT AS customers,"
    " count(*) FILTER (WHERE o_orderpriority LIKE '1%') AS rescued,"
    " min(CASE WHEN o_orderpriority LIKE '1%' THEN 'C' || o_custkey END) AS first_rescued FROM orders GROUP BY 1",
)
def rescued_drift(c: Context):
    """All orders land twice: with whole customer numbers, then the urgent ones with a letter before theirs."""
    root = scratch_dir(c.spark, "drift")
    orders = c.sample.read("orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    urgent = F.col("o_orderpriority").startswith("1")
    lettered = orders.withColumn("o_custkey", F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
    lake = Lake(c.spark, f"{root}/lake")
    for day, landed in enumerate((orders.filter(~urgent), lettered.filter(urgent))):
        landed.write.parquet(f"{root}/landing/{day}")
        copy_into(lake, "orders", f"{root}/landing/*")
    return lake.read(BRONZE, "orders").groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("customers"), F.count("_rescued").alias("rescued"),
        F.min(F.col("_rescued")["o_custkey"]).alias("first_rescued"),
    )
