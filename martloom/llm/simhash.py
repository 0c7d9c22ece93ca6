"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are compared exactly with numpy: exclusive-or and bit counts over tiles, where a pair of
tiles whose population counts differ beyond the radius is skipped (two words that differ in r bits have
counts at most r apart). Not every tile meets every other: two fingerprints within the radius r agree on
at least ``PARTS - r`` of ``PARTS`` equal parts, so it suffices to compare within buckets of equal parts,
one bucket per choice of parts. This loses no pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.tables import LOWER, UPPER, fresh, stored

RADIUS = 2
BITS, PARTS = 64, 4
WIDTH = 3
TILE = 2048
#: A bucket beyond this many fingerprints is cut into chunks that meet pair by pair in different tasks.
CHUNK = 16_384
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The SimHash of a text: bits set in over half of its shingles' XXH64 (seed 42). No words: 0."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(width))))
    hashes = np.fromiter((digest(g, 42) for g in grams), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.fromiter(map(fingerprint, batch.column("text").to_pylist()), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(prints.view(np.int64))],
            names=["doc_id", "text_hash", "fp"],
        )


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` per row: the fingerprint as a signed 64-bit number."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


def _stars(values: np.ndarray, others: np.ndarray | None, radius: int, tile: int = TILE) -> np.ndarray:
    """Links (rows of two) that connect what pairs within the radius connect: one per value at most.

    ``values`` are compared with each other, or with ``others`` where given. Both are sorted by
    population count. A pair of tiles is skipped when the counts in one all differ beyond the radius
    from those in the other. However many pairs are near, a component gives a star.
    """
    nodes = values if others is None else np.concatenate([values, others])
    label = np.arange(len(nodes))
    counts = np.bitwise_count(values).astype(int)
    right, right_counts = (values, counts) if others is None else (others, np.bitwise_count(others).astype(int))
    shift = 0 if others is None else len(values)
    for a in range(0, len(values), tile):
        left = values[a : a + tile]
        low, high = counts[a], counts[a + len(left) - 1]
        for b in range(a if others is None else 0, len(right), tile):
            facing = right[b : b + tile]
            if right_counts[b + len(facing) - 1] < low - radius:
                continue
            if right_counts[b] > high + radius:
                break
            near = np.bitwise_count(left[:, None] ^ facing[None, :]) <= radius
            itself = int(others is None and a == b)
            for i in np.nonzero(near.sum(1) > itself)[0]:
                met = np.unique(np.append(label[shift + b + np.nonzero(near[i])[0]], label[a + i]))
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]
    moved = np.nonzero(label != np.arange(len(nodes)))[0]
    return np.stack([nodes[moved], nodes[label[moved]]], 1)


def _by_count(values: np.ndarray) -> np.ndarray:
    return values[np.lexsort((values, np.bitwise_count(values)))]


def _compare(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell (two chunks of a bucket) to the links found in it."""

    def links(parts: list[np.ndarray], sides: list[np.ndarray]) -> np.ndarray:
        fps, side = np.concatenate(parts).view(np.uint64), np.concatenate(sides)
        left, right = _by_count(fps[side == 0]), _by_count(fps[side == 1])
        return _stars(left, right if len(right) else None, radius)

    def out(found: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.concatenate(found).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    last, parts, sides, found = None, [], [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("choice", "bucket", "one", "two")], 1).astype(np.int64)
        fps, side = batch.column("fp").to_numpy(), batch.column("side").to_numpy()
        cuts = [0, *(np.nonzero((keys[1:] != keys[:-1]).any(1))[0] + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:]):
            key = tuple(keys[start])
            if key != last and parts:
                found.append(links(parts, sides))
                parts, sides = [], []
                if len(found) > 10_000:
                    yield out(found)
                    found = []
            last = key
            parts.append(fps[start:end])
            sides.append(side[start:end])
    if parts:
        found.append(links(parts, sides))
    if found:
        yield out(found)


def linked(prints: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links between distinct fingerprints that connect all pairs within the radius.

    ``prints`` has distinct ``fp``. Buckets with one fingerprint go before the exchange by a count. A
    bucket of more than ``chunk`` fingerprints is cut by a hash into chunks, and each pair of chunks
    becomes a cell of its own, so the largest bucket is shared by many tasks and a cell stays bounded.
    """
    width = BITS // PARTS
    part = [F.shiftrightunsigned("fp", width * i).bitwiseAND(F.lit((1 << width) - 1)) for i in range(PARTS)]
    choices = F.array(*[
        F.struct(F.lit(i).alias("choice"), sum((F.shiftleft(part[p], width * j) for j, p in enumerate(c[1:], 1)), part[c[0]]).alias("bucket"))
        for i, c in enumerate(combinations(range(PARTS), PARTS - radius))
    ])
    keyed = prints.select("fp", F.explode(choices).alias("k")).select("fp", "k.choice", "k.bucket")
    sizes = keyed.groupBy("choice", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    cut = keyed.join(sizes, ["choice", "bucket"]).withColumn("chunks", F.ceil(F.col("n") / chunk).cast("int")).withColumn(
        "mine", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    )
    cells = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda other: F.struct(
        F.least(other, F.col("mine")).alias("one"), F.greatest(other, F.col("mine")).alias("two"),
        (F.col("mine") > other).cast("int").alias("side"),
    ))
    dealt = cut.select("fp", "choice", "bucket", F.explode(cells).alias("c")).select("fp", "choice", "bucket", "c.one", "c.two", "c.side")
    ordered = dealt.repartition("choice", "bucket", "one", "two").sortWithinPartitions("choice", "bucket", "one", "two")
    return ordered.mapInArrow(lambda batches: _compare(batches, radius), "a long, b long").distinct()


def _checksum(edges: DataFrame) -> tuple:
    """Equal for equal sets of links: their number and the sum of their hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root``: the least node of each component, for every node that has a link.

    Alternates two steps until nothing changes: larger neighbours of a node are linked to its least
    neighbour, then smaller ones are. Every step is a grouping of links whose results are stored, so the
    lineage stays short. A node with many links costs rows, not a list: least neighbours are minima.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")

    def least(both: DataFrame) -> DataFrame:
        return both.groupBy("a").agg(F.min("b").alias("m"))

    while True:
        turned = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = least(turned).withColumn("m", F.least("a", "m"))
        large = turned.filter("b > a").join(roots, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        heads = least(low)
        small = low.join(heads, "a").select(
            F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        ).select("e.a", "e.b").filter("a <> b").distinct()
        following = stored(small, "links")
        changed = _checksum(following) != _checksum(edges)
        edges = following
        if not changed:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )


def near_duplicates(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Per row: ``doc_id``, ``text_hash``, the fingerprint in hexadecimal, ``component_id``
    and ``root`` (the fingerprint that stands for the component).

    Documents link when their fingerprints differ in at most ``radius`` bits; the component is named by
    the least ``doc_id`` reachable. Equal fingerprints meet once, whatever the number of copies; the
    copies get their component by a join that Spark splits where one fingerprint is frequent. Rows with a
    null ``doc_id`` take part; a component of such rows alone has a null id. Null and empty texts have
    fingerprint zero and link like any other. Other columns are not read.
    """
    prints = stored(fingerprints(documents), "simhash")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links = stored(linked(distinct.select("fp"), radius), "simhash-links")
    roots = components(links)
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    label = named.join(ids, "root").select("fp", "root", "component_id")
    return prints.join(label, "fp").select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )


def deduplicated(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with all its columns: the one with the least ``doc_id``.

    Of rows with that same id one stays, by the hash of the text; rows without an id come last.
    """
    key, k_key, k_doc = fresh(documents, "key", "k_key", "k_doc")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("f")
    kept = near_duplicates(documents, radius).groupBy("root").agg(first).select(
        F.col("f.doc_id").alias(k_doc), F.xxhash64("f.doc_id", "f.text_hash").alias(k_key)
    )
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = documents.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), text_hash))
    same_id = F.coalesce(F.col("doc_id") == F.col(k_doc), F.col("doc_id").isNull() & F.col(k_doc).isNull())
    # joined on the hash alone, so that dropping repeated rows needs no second exchange of the texts
    return keyed.join(kept, (F.col(key) == F.col(k_key)) & same_id, "left_semi").dropDuplicates([key, "doc_id"]).drop(key)
