"""Registration of queries over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.plans.commercial import commercial_view
from martloom.plans.finance import finance_view
from martloom.plans.mart import Mart
from martloom.plans.metrics import MetricView
from martloom.registry.oracle import compose
from martloom.sources.sample import SampleTables


class Context:
    """What a registered query may read: the sample tables and the mart over them."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sample = SampleTables(spark, sf_dir)

    @cached_property
    def mart(self) -> Mart:
        return self.sample.mart()

    @cached_property
    def commercial(self) -> MetricView:
        return commercial_view(self.mart)

    @cached_property
    def finance(self) -> MetricView:
        return finance_view(self.mart)

    def gold(self, table: str) -> DataFrame:
        return self.mart.gold(table)


@dataclass(frozen=True)
class RegisteredQuery:
    name: str
    build: Callable[[Context], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return presented(self.build(Context(spark, sf_dir)))


QUERIES: dict[str, RegisteredQuery] = {}


def query(
    name: str, sql: str | None = None, reads: tuple[str, ...] = ()
) -> Callable[[Callable[[Context], DataFrame]], Callable[[Context], DataFrame]]:
    """Register a query; ``sql`` restates it for another engine over the ``reads`` relations."""

    def register(build: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = RegisteredQuery(name, build, compose(sql, reads) if sql else None)
        return build

    return register


def presented(df: DataFrame) -> DataFrame:
    """Plain result types that read the same from any engine: doubles for decimals, ISO text for dates."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema.fields])
