"""Quality rules as a bitmask ledger.

Every text is measured once and every rule evaluated once; the ledger keeps the measurements and one
failure bit per rule. Policies are versioned sets of rules applied to the stored bits, and what a rule
does within a policy is computed from the bits alone.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.tables import SPACES

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")
LEDGER_SCHEMA = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)


def measured(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``. Null and empty texts: zeros."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode().split()  # bytes split at exactly the white space of the contract
    n = len(words)
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    grams = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(grams)) < len(grams):
        counts = Counter(grams)
        upto = 0  # words before this one are counted
        for i, gram in enumerate(grams):
            if counts[gram] > 1:
                repeated += i + 3 - max(i, upto)
                upto = i + 3
    upper = sum(text.count(c) for c in set(text) if unicodedata.category(c) == "Lu")
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), repeated, upper


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = list(zip(*map(measured, batch.column("text").to_pylist()))) or [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in columns)],
            names=["doc_id", *MEASURES],
        )


@dataclass(frozen=True)
class Rule:
    """A failure condition over the measurements; ``BITS`` gives it its bit for good."""

    name: str
    fails: Column


def rules() -> list[Rule]:
    c = F.col
    return [
        Rule("few_words", c("n_words") < 50),
        Rule("repeated_words", 100 * c("n_repeat_words") > 50 * c("n_words")),
        Rule("symbols", 10 * c("n_symbols") > c("n_words")),
        Rule("short_words", c("word_chars") < 2 * c("n_words")),
        Rule("long_words", c("word_chars") > 20 * c("n_words")),
        Rule("duplicate_lines", 2 * c("n_dup_lines") > c("n_lines")),
        Rule("capitals", 10 * c("n_upper") > 4 * c("word_chars")),
        Rule("many_words", c("n_words") > 1_000_000),
    ]


BITS = {
    name: bit
    for bit, name in enumerate(
        ("few_words", "repeated_words", "symbols", "short_words", "long_words", "duplicate_lines", "capitals",
         "many_words")
    )
}
BASE = ("few_words", "repeated_words")
#: A published policy is never edited; a change is a new version.
POLICIES = {
    1: (*BASE, "symbols"),
    2: (*BASE, "symbols", "short_words", "long_words", "duplicate_lines", "capitals"),
}


def mask(names: tuple[str, ...]) -> int:
    return sum(1 << BITS[r] for r in names)


def ledger(df: DataFrame) -> DataFrame:
    """One row per row of the input: ``doc_id``, the measurements, and ``fail_bits``.

    Whole texts are measured in the task that reads them; nothing is shuffled. A null text measures as
    empty. Repeated rows keep one ledger row each. Other columns of the input are not read.
    """
    rows = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = F.lit(0).cast("long")
    for rule in rules():
        bits = bits + F.when(rule.fails, F.lit(1 << BITS[rule.name])).otherwise(0)
    return rows.mapInArrow(_measure, LEDGER_SCHEMA).withColumn("fail_bits", bits)


def apply_policy(rows: DataFrame, version: int = 2) -> DataFrame:
    """The ledger with ``policy``, ``base_failed`` and ``kept``, read off the stored bits."""
    bits = F.col("fail_bits")
    return rows.withColumns({
        "policy": F.lit(version),
        "base_failed": bits.bitwiseAND(F.lit(mask(BASE))) != 0,
        "kept": bits.bitwiseAND(F.lit(mask(BASE) | mask(POLICIES[version]))) == 0,
    })


def ablations(rows: DataFrame, version: int = 2) -> DataFrame:
    """Per rule of a policy: documents that fail it, those that fail nothing else, and what the policy
    would keep without it. One pass reduces the ledger to at most ``2 ** rules`` bit patterns first.
    """
    names = POLICIES[version]
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(names))).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")
    )
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << BITS[r]).cast("long").alias("bit")) for r in names]))
    sums = patterns.select("bits", "n", each.alias("r")).groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept"),
    )
    return sums.withColumn("n_kept_without", F.col("n_kept") + F.col("n_only"))
