"""Which analysis a question asks for, by ordered keyword lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Intents in the order they are tried, with the texts that reveal them.
KEYWORDS = (
    ("forecast", ("previsão", "forecast", "projeção", "tendência futura")),
    ("pvm", ("por que", "por quê", "causa", "motivo", "explica", "variação")),
    ("reco", ("recomend", "sugest", "o que fazer", "ação", "melhorar", "next best")),
)


def intent_pattern_sql(text: str, otherwise: str = "NULL") -> str:
    """The same keyword lists as a SQL CASE over regular expressions."""
    whens = " ".join(f"WHEN regexp_matches(lower({text}), '{'|'.join(words)}') THEN '{intent}'" for intent, words in KEYWORDS)
    return f"CASE {whens} ELSE {otherwise} END"


def question_intent(text: Column) -> Column:
    """First intent whose keyword occurs anywhere in the whole text, else NULL."""
    lowered = F.lower(text)
    column = F
    for intent, words in KEYWORDS:
        column = column.when(
            reduce(Column.__or__, [F.contains(lowered, F.lit(w)) for w in words]), intent
        )
    return column
