"""Release checks: grain, orphans, totals, coverage."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def grain_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def grain_summary(tables: Iterable[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """(table, rows, distinct keys, duplicated keys) for several tables."""
    parts = [
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.count_if(F.col("n") > 1).alias("duplicated_keys"),
        )
        .select(F.lit(name).alias("table_name"), "total_rows", "distinct_keys", "duplicated_keys")
        for name, df, key in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def key_profile(df: DataFrame, key: str) -> DataFrame:
    """Row count and distinct keys."""
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct(F.col(key)).alias("distintos")
    )


def orphan_audit(fact: DataFrame, references: Iterable[tuple[str, DataFrame, str]]) -> DataFrame:
    """Per reference: fact keys, and rows holding them, that the dimension does not know.

    One pass over the fact gives (reference, key, rows) with partial counts, so a key held by a third
    of the rows is one row per map task; each reference then meets only its own keys. A missing key
    matches nothing and counts too.
    """
    references = list(references)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key")) for name, _, key in references
    ])).alias("p")
    held = fact.select(pairs).groupBy("p.dimension", "p.key").agg(F.count(F.lit(1)).alias("n"))
    known = reduce(DataFrame.unionByName, [
        dimension.select(F.lit(name).alias("dimension"), F.col(key).cast("string").alias("key"))
        for name, dimension, key in references
    ])
    names = fact.sparkSession.createDataFrame([(name,) for name, _, _ in references], "dimension string")
    unknown = held.join(known, ["dimension", "key"], "left_anti").groupBy("dimension").agg(
        F.count(F.lit(1)).alias("orphan_keys"), F.sum("n").alias("orphan_rows")
    )
    return names.join(unknown, "dimension", "left").select(
        "dimension", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orphan_keys", "orphan_rows")]
    )


def side_by_side(left: Column, left_df: DataFrame, right: Column, right_df: DataFrame) -> DataFrame:
    """Two totals in one row and their difference, each a one-row aggregate beside the other."""
    totals = left_df.agg(left.alias("left_total")).withColumn(
        "right_total", right_df.agg(right.alias("right_total")).scalar()
    )
    return totals.withColumn("difference", F.col("left_total") - F.col("right_total"))


def null_share(df: DataFrame, column: str) -> DataFrame:
    """Rows, rows without a value, and their share in percent with one decimal."""
    rows, filled = F.count(F.lit(1)), F.count(column)
    return df.agg(rows.alias("linhas_venda"), (rows - filled).alias("sem_custo")).withColumn(
        "pct_sem_custo",
        F.round(F.col("sem_custo") * 100.0 / F.nullif(F.col("linhas_venda"), F.lit(0)), 1).cast("double"),
    )


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("linhas"))


def missing_values(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(column).isNull()).alias("missing_rows")
    )
