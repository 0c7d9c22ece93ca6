"""Declared row expectations: drop, track or fail, and a one-pass pass/fail report.

A rule whose condition evaluates to NULL counts as violated.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("drop", "track", "fail")


@dataclass(frozen=True)
class Expectation:
    name: str
    condition: str
    action: str = "drop"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r} in rule {self.name!r}")

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


def enforce(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """Drop rows that break a drop rule; raise at run time on a broken fail rule."""
    checks = []
    for rule in rules:
        if rule.action == "drop":
            checks.append(rule.holds())
        elif rule.action == "fail":
            # raise_error gives a NULL boolean to Catalyst, so the filter keeps only passing rows
            checks.append(
                F.when(rule.holds(), F.lit(True)).otherwise(
                    F.raise_error(F.lit(f"expectation {rule.name} violated")).cast("boolean")
                )
            )
    return df.filter(reduce(Column.__and__, checks)) if checks else df


def marked(df: DataFrame, rules: tuple[Expectation, ...], name: str = "_kept") -> DataFrame:
    """As ``enforce``, but rows that a drop rule breaks stay, told apart by one boolean column."""
    held = [r.holds() for r in rules if r.action == "drop"]
    kept = reduce(Column.__and__, held) if held else F.lit(True)
    return enforce(df, tuple(r for r in rules if r.action == "fail")).withColumn(name, kept)


def flag(df: DataFrame, rules: tuple[Expectation, ...]) -> DataFrame:
    """Keep every row and add one boolean column per rule (true = passes)."""
    return df.withColumns({f"_ok_{r.name}": r.holds() for r in rules})


def quality_report(df: DataFrame, table: str, rules: tuple[Expectation, ...]) -> DataFrame:
    """(table, rule, action, passed, failed), all rules counted in a single aggregation."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(~r.holds()).alias(f"_f{i}") for i, r in enumerate(rules)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(r.name).alias("rule_name"),
                F.lit(r.action).alias("action"),
                (F.col("_rows") - F.col(f"_f{i}")).alias("passed"),
                F.col(f"_f{i}").alias("failed"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.inline(entries))


def observed(
    df: DataFrame, table: str, rules: tuple[Expectation, ...]
) -> tuple[DataFrame, Observation]:
    """Marked rows plus counts gathered while they are written, without another pass."""
    observation = Observation(f"quality_{table}_{uuid4().hex}")
    watched = df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~r.holds()).alias(r.name) for r in rules],
    )
    return marked(watched, rules), observation
