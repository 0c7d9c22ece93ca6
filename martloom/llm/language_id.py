"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram is the product of its letters' vectors, each
rotated by the letter's distance from the end (binding keeps the order), and a text is the sum of its n-grams
(bundling). A language is the sum over its documents; a document gets the language at the least angle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMS = 1024
GRAM = 3
SEED = 11
#: The symbol of everything between words.
BLANK = 0x20
#: Symbols counted at once, documents bundled at once, and n-grams whose vectors are built at once.
SLICE, GROUP, BLOCK = 1 << 20, 512, 8192
#: Profiles travel to every task; more languages than this are an error, never dropped.
MOST_LANGUAGES = 1000
UNKNOWN = "und"


def symbol_vector(symbol: int, dims: int = DIMS, seed: int = SEED) -> np.ndarray:
    """+1 and -1, fixed by symbol and seed."""
    bits = hashlib.shake_256(f"{seed}:{symbol}".encode()).digest(dims // 8)
    return np.unpackbits(np.frombuffer(bits, np.uint8)).astype(np.int8) * 2 - 1


def symbols(text: str) -> Iterator[np.ndarray]:
    """The lower-cased letters of a text as code points, one blank between words and at either end.

    Long texts come in slices; each begins with the last ``GRAM - 1`` symbols of the one before, so every
    n-gram lies in exactly one. A text without a letter gives nothing.
    """
    text = text.lower()
    tail, any_letter = np.array([BLANK], np.uint32), False
    for start in range(0, len(text), SLICE):
        points = np.frombuffer(text[start : start + SLICE].encode("utf-32-le", "surrogatepass"), "<u4")
        there = np.flatnonzero(np.bincount(points))
        letters = np.zeros(int(there[-1]) + 1, bool)
        letters[[p for p in there.tolist() if chr(p).isalpha()]] = True
        is_letter = letters[points]
        any_letter = any_letter or bool(is_letter.any())
        seen = np.concatenate([tail, np.where(is_letter, points, BLANK).astype(np.uint32)])
        blank = seen == BLANK
        # of a run of blanks the first stays; what the tail holds has been through this before
        keep = ~blank | np.concatenate([[True], ~blank[:-1]])
        seen = seen[keep]
        if len(seen) >= GRAM:
            yield seen
        tail = seen[-(GRAM - 1) :]
    if any_letter and tail[-1] != BLANK:
        yield np.append(tail, np.uint32(BLANK))


def bundles(numbered: Iterator[tuple[int, np.ndarray]], rows: int, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Per row the sum of the vectors of its n-grams, and their number; slices come as (row, symbols)."""
    total, grams = np.zeros((rows, dims)), np.zeros(rows, np.int64)
    held: list[tuple[int, np.ndarray]] = []

    def add() -> None:
        points, index = np.unique(np.concatenate([s for _, s in held]), return_inverse=True)
        base, codes, owners, at = len(points), [], [], 0
        for row, s in held:
            part = index[at : at + len(s)].astype(np.int64)
            at += len(s)
            code = part[: len(part) - GRAM + 1]
            for j in range(1, GRAM):
                code = code * base + part[j : len(part) - GRAM + 1 + j]
            codes.append(code)
            owners.append(np.full(len(code), row))
        encoded = pa.array(np.concatenate(codes)).dictionary_encode()
        which, of = encoded.indices.to_numpy().astype(np.int64), np.concatenate(owners)
        distinct = encoded.dictionary.to_numpy()
        grams[:] += np.bincount(of, minlength=rows)
        vectors = np.stack([symbol_vector(int(p), dims) for p in points])
        rotated = [np.roll(vectors, GRAM - 1 - j, 1) for j in range(GRAM)]
        for low in range(0, len(distinct), BLOCK):
            some = distinct[low : low + BLOCK]
            bound = np.ones((len(some), dims), np.int8)
            for j in range(GRAM):
                bound *= rotated[j][some // base ** (GRAM - 1 - j) % base]
            inside = slice(None) if len(distinct) <= BLOCK else (which >= low) & (which < low + BLOCK)
            cells = of[inside] * len(some) + (which[inside] - low)
            counts = np.bincount(cells, minlength=rows * len(some)).reshape(rows, -1)
            # counts of a slice stay far below 2**24, so these sums are exact
            total[:] += counts.astype(np.float32) @ bound.astype(np.float32)

    size = 0
    for row, s in numbered:
        held.append((row, s))
        size += len(s)
        if size >= SLICE:
            add()
            held, size = [], 0
    if held:
        add()
    return total, grams


@dataclass(frozen=True)
class Profiles:
    """Learned language names in order, and their bundled vectors."""

    names: list[str]
    vectors: np.ndarray


def _summed(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """One row per language and task."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text")
        for low in range(0, len(langs), GROUP):
            mine = langs[low : low + GROUP]
            names = sorted(set(mine))
            row = {name: i for i, name in enumerate(names)}
            slices = ((row[name], s) for name, t in zip(mine, texts.slice(low, GROUP)) for s in symbols(t.as_py()))
            total, grams = bundles(slices, len(names), dims)
            for name, vector, n in zip(names, total.astype(np.int64), grams):
                if n:
                    sums[name] = sums.get(name, 0) + vector
    for name, vector in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([vector.tolist()], pa.list_(pa.int64()))], names=["lang", "sums"]
        )


def fit(documents: DataFrame, held_out: Callable[[Column], Column], dims: int = DIMS) -> Profiles:
    """Profiles of every ``lang`` that is not null, from all documents that are not held out.

    Tasks bundle their own documents, so a language with most of the rows is no large group; what
    is sent to the driver is one vector per language. Rows with a null ``doc_id`` are learned from.
    """
    free = ~F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    rows = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & free).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    parts = rows.mapInArrow(lambda b: _summed(b, dims), "lang string, sums array<long>")
    sums = parts.select("lang", F.posexplode("sums").alias("at", "s")).groupBy("lang", "at").agg(F.sum("s").alias("s"))
    per = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "s"))).alias("v"))  # dims entries each
    found = per.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of lang: no table of languages")
    return Profiles([r["lang"] for r in found], np.array([[e["s"] for e in r["v"]] for r in found], float).reshape(-1, dims))


def _named(batches: Iterator[pa.RecordBatch], profiles: Profiles) -> Iterator[pa.RecordBatch]:
    dims = profiles.vectors.shape[1]
    towards = profiles.vectors / np.maximum(np.linalg.norm(profiles.vectors, axis=1), 1e-300)[:, None]
    for batch in batches:
        texts = batch.column("text")
        for low in range(0, len(texts), GROUP):
            part = texts.slice(low, GROUP)
            slices = ((i, s) for i, t in enumerate(part) if t.is_valid for s in symbols(t.as_py()))
            total, grams = bundles(slices, len(part), dims)
            near = total @ towards.T / np.maximum(np.linalg.norm(total, axis=1), 1e-300)[:, None]
            best = near.argmax(1) if len(profiles.names) else np.zeros(len(part), int)
            known = (grams > 0) & bool(profiles.names)
            score = np.where(known, near[np.arange(len(part)), best].clip(0, 1), 0.0) if len(profiles.names) else np.zeros(len(part))
            names = [profiles.names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(low, GROUP), pa.array(names, pa.string()), pa.array(score.round(12))],
                names=["doc_id", "lang_pred", "score"],
            )


def identified(documents: DataFrame, profiles: Profiles) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row: the profile at the least angle, and the cosine (0 at least).

    Only ``text`` is looked at. A null text, a text without a letter (Unicode category L) or a lack of
    profiles gives ``und`` and 0; at equal cosines the first name in order wins. Very long texts are read in
    slices, whole. Repeated rows and null ids stay as they are; other columns are not read.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _named(b, profiles), "doc_id long, lang_pred string, score double")
