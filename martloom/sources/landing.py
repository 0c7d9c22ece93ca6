"""Landing folders: Parquet scans, file listings, control-table discovery."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.streaming.file_stream import one_form

WATERMARK_PATTERN = "updat|modif"  # fixed value: names of change-tracking columns
COLUMN_LIST_SCHEMA = "table_schema string, table_name string, column_name string"


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    """A look at the first rows."""
    return df.limit(rows)


def scan_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)


def dated_folder(root: str, source: str, table: str, day: date) -> str:
    """Where one day's extract of a source table lands."""
    return f"{root.rstrip('/')}/{source}/{table}/{day:%Y/%m/%d}"


def all_days(root: str, source: str, table: str) -> str:
    """Pattern over every day's folder of a table, for batch reads and file streams."""
    return f"{root.rstrip('/')}/{source}/{table}/*/*/*"


def _listed(spark: SparkSession, pattern: str, recursive: bool) -> list[tuple[str, int]]:
    """Paths and sizes below a folder or pattern, from the file system's own listing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for top in fs.globStatus(path) or ():
        if recursive and top.isDirectory():
            inside = fs.listFiles(top.getPath(), True)
            while inside.hasNext():
                status = inside.next()
                found.append((status.getPath().toString(), status.getLen()))
        else:
            found.append((top.getPath().toString(), top.getLen()))
    return found


def listed_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, file_bytes`` of the Parquet files below a folder or pattern, from Spark's own listing.

    Many folders are listed by tasks side by side, no file is opened, and no name passes through Python.
    """
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "file string, file_bytes long")
    return files.select(one_form(F.col("path")).alias("file"), F.col("length").alias("file_bytes"))


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below a folder: path, name, bytes, rows. A file without rows counts 0."""
    files = listed_files(spark, path)
    if files.isEmpty():
        rows = spark.createDataFrame([], "file string, file_rows long")
    else:
        reader = spark.read.schema("_none int").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        found = reader.parquet(path).groupBy(one_form(F.col("_metadata.file_path")).alias("file"))
        rows = found.agg(F.count(F.lit(1)).alias("file_rows"))
    return files.join(rows, "file", "left").select(
        F.col("file").alias("file_path"), F.element_at(F.split("file", "/"), -1).alias("file_name"), "file_bytes",
        F.coalesce("file_rows", F.lit(0)).alias("file_rows"),
    )


def landed_tables(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables that lie in a folder, each a Parquet file or a folder of such files."""
    names = {p.rstrip("/").rsplit("/", 1)[-1] for p, _ in _listed(spark, f"{root.rstrip('/')}/*.parquet", False)}
    return sorted(n.removesuffix(".parquet") for n in names)


def discover_columns(
    spark: SparkSession, tables: Mapping[str, DataFrame], schema: str = "landing"
) -> DataFrame:
    """Column list of a set of tables, shaped like ``information_schema.columns``."""
    rows = [(schema, name, field.name) for name, df in tables.items() for field in df.schema]
    return spark.createDataFrame(rows, COLUMN_LIST_SCHEMA)


def discover_catalog(spark: SparkSession, database: str) -> DataFrame:
    """Column list of the stored base tables of a catalog database."""
    rows = [
        (database, table.name, column.name)
        for table in spark.catalog.listTables(database)
        if not table.isTemporary and table.tableType in ("MANAGED", "EXTERNAL")
        for column in spark.catalog.listColumns(f"{database}.{table.name}")
    ]
    return spark.createDataFrame(rows, COLUMN_LIST_SCHEMA)


def watermark_candidates(columns: DataFrame, pattern: str = WATERMARK_PATTERN) -> DataFrame:
    """One change-tracking column per table; the alphabetically first, so reruns agree."""
    return (
        columns.filter(F.lower("column_name").rlike(pattern))
        .groupBy("table_schema", "table_name")
        .agg(F.min("column_name").alias("watermark_column"))
    )


def control_table(columns: DataFrame, ingestion_mode: str = "copy_into") -> DataFrame:
    """One row per source table with its load settings."""
    tables = columns.select("table_schema", "table_name").distinct()
    return tables.join(
        watermark_candidates(columns), ["table_schema", "table_name"], "left"
    ).select(
        F.col("table_schema").alias("source_schema"),
        F.col("table_name").alias("source_table"),
        F.col("table_name").alias("target_folder"),
        F.when(F.col("watermark_column").isNotNull(), "incremental").otherwise("full").alias("load_type"),
        "watermark_column",
        F.lit(ingestion_mode).alias("ingestion_mode"),
        F.lit(True).alias("is_active"),
    )


def load_state(tables: Mapping[str, DataFrame], watermarks: Mapping[str, str]) -> DataFrame:
    """Per table: rows to load and, where it has a watermark column, the newest mark.

    Marks are kept as text in the full precision of their column; ``rows_since`` reads them back in
    the column's own type.
    """
    parts = []
    for name, df in tables.items():
        mark = F.max(F.col(watermarks[name])).cast("string") if name in watermarks else F.lit(None).cast("string")
        parts.append(
            df.agg(F.count(F.lit(1)).alias("source_rows"), mark.alias("high_water_mark")).select(
                F.lit(name).alias("source_table"), "source_rows", "high_water_mark"
            )
        )
    return reduce(DataFrame.unionByName, parts)


def store_marks(state: DataFrame, location: str) -> None:
    """Remember how far each table of ``load_state`` has been loaded; the last mark of a table counts."""
    state.filter("high_water_mark IS NOT NULL").select(
        "source_table", "high_water_mark", F.current_timestamp().alias("marked_at")
    ).write.mode("append").parquet(location)


def stored_mark(spark: SparkSession, location: str, table: str) -> str | None:
    """The mark stored last for a table, None before the first."""
    if not _listed(spark, location, False):
        return None
    marks = spark.read.parquet(location).filter(F.col("source_table") == table)
    return marks.agg(F.max_by("high_water_mark", "marked_at")).first()[0]


def rows_since(df: DataFrame, column: str, high_water_mark: object) -> DataFrame:
    """Rows changed after the stored mark, all rows where there is none; the comparison reaches the scan."""
    if high_water_mark is None:
        return df
    return df.filter(F.col(column) > F.lit(high_water_mark).cast(df.schema[column].dataType))


def control_json(control: DataFrame) -> DataFrame:
    """Active control rows as JSON documents, ready for ``write.text``."""
    return control.filter("is_active").select(
        "source_table", F.to_json(F.struct(*control.columns)).alias("document")
    )


def write_control_json(control: DataFrame, path: str) -> None:
    control.filter("is_active").write.mode("overwrite").json(path)
