from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from martloom.llm import queries as llm_queries  # noqa: E402
from martloom.llm.tables import table  # noqa: E402

LONG = "word " * 30_000
#: Nulls, empty and long texts, ties, repeated rows, odd characters.
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, LONG), (4, LONG), (None, "orphan text of no id"), (None, None),
    (7, "Same Words Here"), (7, "same words here"), (8, "\x00 nul   and   noél \U0001f600 Á"), (9, "x" * 700),
    (10, "x" * 450 + "tail"), (11, "one"), (12, "!!! ### $$$"), (-5, "same words here"), (13, "ⒶⒷⒸ ⒹⒺⒻ " * 30),
]


@pytest.fixture(scope="session")
def rows_of(spark):
    """A frame of (doc_id, text) with further columns whose names the operators use themselves."""

    def make(rows, lang="en", source="src1"):
        extra = (
            "doc_id long, text string, lang string, source string, shard string, slot string, fp string, g string, "
            "words string, h string, key string, row string, n string, root string, budget string, copies string, tokens string"
        )
        return spark.createDataFrame([(i, t, lang, source, *["clash"] * 13) for i, t in rows], extra)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def result(spark, sf_dir):
    """The rows of a registered query, run once."""
    kept = {}

    def run(name):
        if name not in kept:
            df = llm_queries.QUERIES[name](spark, sf_dir)
            kept[name] = (df.columns, [tuple(r) for r in df.collect()])
        return kept[name][1]

    return run
