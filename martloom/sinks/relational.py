"""Publishing gold and analytic tables to a serving target, and reconciling the counts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from typing import Protocol
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martloom.operators.digests import content_differences
from martloom.plans.contracts import CONTRACTS
from martloom.sinks.lake import Lake
from martloom.sources.jdbc import read_table


@dataclass(frozen=True)
class Publication:
    source: str
    destination: str
    primary_key: tuple[str, ...]
    indexes: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()


# Destination schemas, and keys of the analytic tables.
ANALYTIC_TABLES = (
    Publication("forecast_sales", "ml.forecast_sales", ("ds",)),
    Publication(
        "reco_customer_actions", "ml.reco_customer_actions", ("customer_key",), ("segment", "priority")
    ),
    Publication(
        "pvm_drivers", "ml.pvm_drivers", ("comparison_type", "year_month", "subcategory"), ("subcategory",)
    ),
)
MANIFEST: tuple[Publication, ...] = (
    *(
        Publication(c.name, f"gold.{c.name}", c.primary_key, c.indexes, c.unique)
        for c in CONTRACTS.values()
    ),
    *ANALYTIC_TABLES,
)


class Target(Protocol):
    def write(self, df: DataFrame, destination: str) -> None: ...

    def read(self, destination: str) -> DataFrame: ...


@dataclass(frozen=True)
class JdbcTarget:
    """A database. Overwrite truncates, so keys and indexes defined there survive."""

    spark: SparkSession
    connection: Mapping[str, str]
    max_connections: int = 8
    batch_size: int = 5000

    def write_options(self, destination: str) -> dict[str, str]:
        """The writer itself narrows the data to ``numPartitions`` connections."""
        return {
            **self.connection,
            "dbtable": destination,
            "truncate": "true",
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.max_connections),
        }

    def write(self, df: DataFrame, destination: str) -> None:
        df.write.format("jdbc").options(**self.write_options(destination)).mode("overwrite").save()

    def read(self, destination: str) -> DataFrame:
        return read_table(self.spark, self.connection, destination)


@dataclass(frozen=True)
class LakeTarget:
    """The same publication as Parquet folders, for targets that read files."""

    lake: Lake

    def write(self, df: DataFrame, destination: str) -> None:
        schema, table = destination.split(".")
        self.lake.replace(df, schema, table)

    def read(self, destination: str) -> DataFrame:
        schema, table = destination.split(".")
        return self.lake.read(schema, table)


def publish(
    table: Callable[[str], DataFrame],
    target: Target,
    manifest: Iterable[Publication] = MANIFEST,
    parallel_tables: int = 4,
) -> dict[str, int]:
    """Write each listed table, several side by side; returns the rows written by destination.

    Rows are counted as they are written, so no source is composed again for its count.
    """

    def one(entry: Publication) -> tuple[str, int]:
        rows = Observation(f"published_{uuid4().hex}")
        target.write(table(entry.source).observe(rows, F.count(F.lit(1)).alias("rows")), entry.destination)
        return entry.destination, rows.get["rows"]

    with ThreadPoolExecutor(max_workers=parallel_tables) as pool:
        return dict(pool.map(one, manifest))


def reconcile(spark: SparkSession, written: Mapping[str, int], target: Target) -> DataFrame:
    """Rows written and rows found in the target per table, differing ones first."""
    result = None
    for destination, rows in written.items():
        found = target.read(destination).agg(F.count(F.lit(1)).alias("target_rows")).select(
            F.lit(destination).alias("table_name"), F.lit(rows).cast("long").alias("source_rows"), "target_rows"
        )
        result = found if result is None else result.unionByName(found)
    status = F.when(F.col("source_rows") == F.col("target_rows"), "OK").otherwise("DIVERGE")
    return result.withColumn("status", status).orderBy("status", "table_name")


def reconcile_content(
    table: Callable[[str], DataFrame], target: Target, manifest: Iterable[Publication] = MANIFEST
) -> DataFrame:
    """Every key whose published rows differ from the source: table, key as JSON, kind, and rows on either side."""
    parts = []
    for entry in manifest:
        found = content_differences(table(entry.source), target.read(entry.destination), entry.primary_key)
        parts.append(found.select(
            F.lit(entry.destination).alias("table_name"),
            F.to_json(F.struct(*entry.primary_key), {"ignoreNullFields": "false"}).alias("key"),
            "kind", "source_rows", "target_rows",
        ))
    return reduce(DataFrame.unionByName, parts)


def manifest_rows(
    spark: SparkSession, manifest: Iterable[Publication] = MANIFEST
) -> DataFrame:
    """The manifest as rows, for use by whatever creates keys and indexes in the target."""
    return spark.createDataFrame(
        [
            (m.source, m.destination, list(m.primary_key), list(m.indexes), [list(u) for u in m.unique])
            for m in manifest
        ],
        "source string, destination string, primary_key array<string>, indexes array<string>, "
        "unique_keys array<array<string>>",
    )
