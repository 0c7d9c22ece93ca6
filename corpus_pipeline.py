"""The corpus pipeline: stages from raw documents to shards, each stored before the next reads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martloom.llm import decontaminate, mixing, simhash, toxicity
from martloom.llm.queries import held_out
from martloom.llm.sharding import shard_rows
from martloom.llm.tables import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: No document twice in one mix: repeated epochs would undo the stage before.
MIX = mixing.Mix(max_epochs=1)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon, fitted on the labelled ones that are not held out, does not reject."""
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels"), held_out)
    return toxicity.kept_documents(docs, lexicon)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the budgets of their leaves select."""
    return mixing.mixed(docs, MIX)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot."""
    return shard_rows(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing_to_weights),
    ("sharding", sharding),
]
#: No SQL restates a fitted lexicon or a hash that DuckDB lacks; tests use a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
