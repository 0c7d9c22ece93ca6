"""Relational sources over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# Catalog schemas that never hold business tables.
SYSTEM_SCHEMAS = ("pg_catalog", "information_schema")


def _outside_system_schemas() -> str:
    return ", ".join(f"'{s}'" for s in SYSTEM_SCHEMAS)


def columns_query() -> str:
    """Columns of base tables outside the system schemas, with the column list's shape."""
    return (
        "SELECT c.table_schema, c.table_name, c.column_name "
        "FROM information_schema.columns c "
        "JOIN information_schema.tables t "
        "ON t.table_schema = c.table_schema AND t.table_name = c.table_name "
        "WHERE t.table_type = 'BASE TABLE' "
        f"AND c.table_schema NOT IN ({_outside_system_schemas()})"
    )


def query_options(connection: Mapping[str, str], query: str) -> dict[str, str]:
    """Options for a statement run by the database itself."""
    return {**connection, "query": query}


def table_options(
    connection: Mapping[str, str],
    table: str,
    split: tuple[str, object, object, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options for a table scan; ``split`` is (column, lower, upper, partitions) for parallel reads."""
    options = {**connection, "dbtable": table, "fetchsize": str(fetch_size)}
    if split is not None:
        column, lower, upper, partitions = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_query(spark: SparkSession, connection: Mapping[str, str], query: str) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(connection, query)).load()


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    split: tuple[str, object, object, int] | None = None,
) -> DataFrame:
    return spark.read.format("jdbc").options(**table_options(connection, table, split)).load()


def discover_columns(spark: SparkSession, connection: Mapping[str, str]) -> DataFrame:
    return read_query(spark, connection, columns_query())
