"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, homoglyphs, digits that stand for letters) and matched with an
Aho-Corasick automaton. Entries are whole words or the beginnings of words, with weights learned from
labelled documents; an exception phrase that covers a match cancels it. The weight found is normalised
by the length of the text and turned into a score by a logistic curve.
"""

from __future__ import annotations

import heapq
import math
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import astuple, dataclass
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.tables import stored

THRESHOLD = 0.3
#: Labelled rows that the lexicon and the curve are fitted on, at most.
FIT_ROWS = 20_000
SKETCH_WORDS = 16
SHORTEST, LONGEST = 4, 12

#: Digits and signs read as letters, and letters of other scripts read as Latin ones.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"}
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ł": "l", "ø": "o", "đ": "d",
}
#: Phrases in which a word of the lexicon is harmless.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "class clown", "rodeo clown", "clown fish", "clown school",
    "sore loser", "keep it simple stupid", "not stupid", "not an idiot", "pond scum", "soap scum",
)


class _Fold(dict):
    """Character to folded character, computed once per character; anything but a letter is a space."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        folded = []
        for c in unicodedata.normalize("NFKD", char).lower():
            c = DIGITS.get(c) or HOMOGLYPHS.get(c) or c
            if c.isalpha():
                folded.append(c)
            elif not unicodedata.combining(c):
                folded.append(" ")
        self[code] = "".join(folded)
        return self[code]


_FOLD = _Fold()


def folded(text: str | None) -> str:
    """Words of folded letters with single spaces between and around them."""
    return f" {' '.join((text or '').translate(_FOLD).split())} "


@dataclass(frozen=True)
class Lexicon:
    """Weights by entry (a word is written ``' word '``, a beginning ``' begin'``), and the curve."""

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, float, float] = (-4.0, 1.5, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            entry = folded(phrase)
            found.add_word(entry, (len(entry), None))
        if len(found):
            found.make_automaton()
        return found


def matched_weight(automaton: ahocorasick.Automaton, text: str) -> float:
    """Summed weights of the words matched in a folded text; each word counts once, by its heaviest entry."""
    if not len(automaton):
        return 0.0
    by_start: dict[int, float] = {}
    covered: list[tuple[int, int]] = []
    for end, (length, weight) in automaton.iter(text):
        start = end - length + 1
        if weight is None:
            covered.append((start, end))
        elif weight > by_start.get(start, -math.inf):
            by_start[start] = weight
    if not covered:
        return sum(by_start.values())
    covered.sort()
    firsts = [a for a, _ in covered]
    reach = list(accumulate((b for _, b in covered), max))  # how far the phrases that begin up to here reach
    return sum(w for s, w in by_start.items() if not (i := bisect_right(firsts, s)) or s >= reach[i - 1])


def features(weight: float, n_words: int) -> tuple[float, float]:
    """What the curve sees: the weight per root of the length, and per hundred words."""
    return math.log1p(weight / math.sqrt(max(n_words, 1)) * 5), math.log1p(100 * weight / max(n_words, 20))


def score(curve: tuple[float, float, float], weight: float, n_words: int) -> float:
    x, y = features(weight, n_words)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, curve[0] + curve[1] * x + curve[2] * y))))


def _training(documents: DataFrame, labels: DataFrame, held_out, rows: int) -> DataFrame:
    """``text, toxic`` of at most about ``rows`` labelled rows, chosen by a hash of the id."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("l_doc")).agg(F.max("toxic").alias("toxic"))
    total = known.count()
    if total > rows:
        known = known.filter(F.pmod(F.xxhash64("l_doc", F.lit(3)), F.lit(1_000_000)) < int(1_000_000 * rows / total))
    # at most about FIT_ROWS ids, some 16 bytes each
    return documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(known), F.col("doc_id") == F.col("l_doc")
    ).select("text", "toxic")


def _sketch(text: str) -> str:
    """The least-hashed longer words: equal for copies and most near copies of a text.

    Texts of unlike words do not share that many; a text with too few longer words gives words of any length.
    """
    words = set(folded(text).split())
    longer = {w for w in words if len(w) >= 6}
    chosen = longer if len(longer) >= SKETCH_WORDS else words
    return ",".join(f"{h:x}" for h in heapq.nsmallest(SKETCH_WORDS, map(xxhash.xxh64_intdigest, chosen)))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sketches = [_sketch(t) or t for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("text"), batch.column("toxic").cast(pa.int32()), pa.array(sketches, pa.string())],
            names=["text", "toxic", "sketch"],
        )


def _entries(text: str) -> set[str]:
    out = set()
    for word in set(folded(text).split()):
        if len(word) >= SHORTEST - 1:
            out.add(f" {word} " if len(word) <= 2 * LONGEST else f" {word[:LONGEST]}")
        for n in range(SHORTEST, min(len(word), LONGEST) + 1):
            out.add(f" {word[:n]}")
    return out


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: dict[str, list[int]] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for entry in _entries(text):
                counts.setdefault(entry, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts, pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
             pa.array([c[1] for c in counts.values()], pa.int64())], names=["entry", "clean", "toxic"],
        )


def _significant(toxic: int, clean: int, share: float) -> float:
    """How surprising it is (nats) that so many of the documents with an entry are toxic: a Chernoff bound."""
    n = toxic + clean
    rate = toxic / n
    if rate <= share:
        return 0.0
    rest = (1 - rate) * math.log((1 - rate) / (1 - share)) if rate < 1 else 0.0
    return n * (rate * math.log(rate / share) + rest)


def chosen_entries(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Weights of the entries worth keeping from their document counts (clean, toxic).

    An entry must be far more frequent in toxic documents than chance among that many candidates allows.
    A longer entry is dropped when its own beginning is as telling; the weight is the log ratio of rates.
    """
    share = n_toxic / max(1, n_toxic + n_clean)
    bar = math.log(max(2, len(rows))) + 5
    weights: dict[str, float] = {}
    for entry, clean, toxic in sorted(rows, key=lambda r: (len(r[0].rstrip()), r[0].endswith(" "), r[0])):
        if _significant(toxic, clean, share) < bar:
            continue
        weight = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
        if weight < 2.0:
            continue
        word = entry.rstrip()
        shorter = max((weights.get(word[:n], 0.0) for n in range(SHORTEST, len(word) + 1)), default=0.0)
        if shorter < weight - 1.5:
            weights[entry] = weight
    closed = _closed(weights, {entry: toxic for entry, _, toxic in rows})
    return dict(sorted(closed.items(), key=lambda x: (-x[1], x[0])))


def _closed(weights: dict[str, float], toxic: dict[str, int]) -> dict[str, float]:
    """Each entry made as long as it can be while almost as many toxic documents hold it.

    ``' path'`` becomes ``' pathetic '`` where that is the word behind it, and the beginning of a family
    of words stays what they have in common.
    """
    longer: dict[str, list[str]] = {}
    for entry in toxic:
        word = entry.rstrip()
        above = word[: LONGEST + 1] if entry.endswith(" ") else word[:-1]
        longer.setdefault(above, []).append(entry)
    out: dict[str, float] = {}
    for entry, weight in weights.items():
        while further := [e for e in longer.get(entry, ()) if toxic[e] >= 0.97 * toxic[entry]]:
            entry = max(further, key=lambda e: (toxic[e], e))
        out[entry] = max(weight, out.get(entry, 0.0))
    # a beginning whose toxic documents mostly hold one chosen longer entry adds harmless words only
    told = lambda e: any(o != e and o.startswith(e.rstrip()) and toxic[o] >= 0.5 * toxic[e] for o in out)
    return {e: w for e, w in out.items() if not told(e)}


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """A logistic curve that rises with both features; one that would fall is left out."""
    first = _logistic(x, y)
    for j in (0, 1):
        if first[j + 1] < 0:
            other = x.copy()
            other[:, j] = 0
            return _logistic(other, y)
    return first


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton steps with a small ridge; three numbers."""
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(3)
    ridge = np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        step = np.linalg.solve(
            design.T @ (design * (p * (1 - p))[:, None]) + ridge, design.T @ (y - p) - ridge @ beta
        )
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1]), float(beta[2])


def fit(documents: DataFrame, labels: DataFrame, held_out, rows: int = FIT_ROWS) -> Lexicon:
    """The lexicon from labelled documents that are not held out, at most about ``rows`` of them.

    Document counts of words and word beginnings are summed by Spark; only entries frequent enough in
    toxic documents to pass the test come to the driver, and one pair of numbers per fitted row for the
    curve. Without toxic or clean rows the lexicon is empty and the curve gives the rate of toxic rows.
    """
    # copies and near copies are one witness, not many
    sketched = _training(documents, labels, held_out, rows).mapInArrow(_sketched, "text string, toxic int, sketch string")
    copies = Window.partitionBy("sketch", "toxic").orderBy(F.xxhash64("text"))
    first = sketched.withColumn("copy", F.row_number().over(copies)).filter("copy = 1")
    sample = stored(first.select("text", "toxic"), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        rate = (n_toxic + 0.5) / (n_toxic + n_clean + 1) if n_toxic + n_clean else 0.05
        return Lexicon({}, curve=(math.log(rate / (1 - rate)), 0.0, 0.0))
    counts = sample.mapInArrow(_entry_counts, "entry string, clean long, toxic long").groupBy("entry").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    floor = max(3, n_toxic // 500)
    likely = counts.filter((F.col("toxic") >= floor) & (F.col("toxic") * n_clean > 4 * F.col("clean") * n_toxic))
    weights = chosen_entries([(r["entry"], r["clean"], r["toxic"]) for r in likely.collect()], n_toxic, n_clean)
    lexicon = Lexicon(weights)
    rows_in = sorted(_weighed(sample, lexicon, ["toxic"]).collect())  # sums of floats in one order
    x = np.array([features(r["weight"], r["n_words"]) for r in rows_in])
    return Lexicon(weights, curve=_fit_curve(x, np.array([r["toxic"] for r in rows_in], float)))


def _weighed(rows: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """``keep`` columns with the matched weight and the number of folded words."""
    sent = rows.sparkSession.sparkContext.broadcast((lexicon.weights, lexicon.exceptions))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Lexicon(*sent.value).automaton()
        for batch in batches:
            weights, words = [], []
            for text in batch.column("text").to_pylist():
                plain = folded(text)
                weights.append(matched_weight(automaton, plain))
                words.append(plain.count(" ") - 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(weights, pa.float64()), pa.array(words, pa.int64())],
                names=[*keep, "weight", "n_words"],
            )

    fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "text").mapInArrow(weigh, f"{fields}, weight double, n_words long")


def _scores(lexicon: Lexicon, automaton: ahocorasick.Automaton, texts: pa.Array) -> list[float]:
    out = []
    for text in texts.to_pylist():
        plain = folded(text)
        out.append(score(lexicon.curve, matched_weight(automaton, plain), plain.count(" ") - 1))
    return out


def scored(documents: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id, score, predicted``. Only the text is read for a score.

    Null and empty texts match nothing and get the score of no weight. Whole texts are matched in the
    task that reads them; repeated rows are scored one by one.
    """
    sent = documents.sparkSession.sparkContext.broadcast(astuple(lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(*sent.value)
        automaton = lexicon.automaton()
        for batch in batches:
            scores = _scores(lexicon, automaton, batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                names=["doc_id", "score", "predicted"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, predicted int")


def kept_documents(documents: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, with all their columns, that are not predicted toxic.

    Rows are dropped by the task that reads them, so nothing is shuffled.
    """
    sent = documents.sparkSession.sparkContext.broadcast(astuple(lexicon))
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(*sent.value)
        automaton = lexicon.automaton()
        for batch in batches:
            scores = _scores(lexicon, automaton, batch.column(place))
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
