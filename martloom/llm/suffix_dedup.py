"""Removal of repeated 200-byte strings by bucket-pointer refinement over sampled suffixes.

A byte goes when a ``LENGTH``-byte string that covers it also starts anywhere else. Suffixes that share
their first ``LENGTH`` bytes are found by refining buckets:

1. *Sampling.* In every window of ``LENGTH`` bytes the q-gram with the least hash is its anchor (the
   leftmost of equals). Equal windows have equal anchors at equal offsets, so only anchors (about one in
   85 positions) stand for the suffixes around them. A *run* is the stretch of windows with one anchor.
2. *Initial buckets.* Anchors fall into buckets by their q-gram. A bucket of one is done: nothing that
   starts in its run is repeated.
3. *Refinement by the bytes around.* Runs of a bucket with equal bytes throughout form a class; a class
   of two or more is repeated as a whole, and counts as one from here on.
4. *Refinement by bucket pointers.* In buckets with several classes every window start gets the bucket
   of its first 25 bytes, then the bucket of (its bucket, the bucket 25 bytes later), then 50 and 100
   bytes later, each step using the identifiers of the last: after three steps equal identifiers mean
   200 equal bytes. A start whose bucket or later bucket holds nothing else drops out at once. Buckets
   small enough for a task are refined in it; in larger ones the steps run in the rows and Spark counts the last buckets.
5. The windows found become spans of their documents, and the bytes outside the spans are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.tables import fresh, stored

LENGTH, GRAM, STEP = 200, 24, 25  # STEP * 2**3 == LENGTH
_PER_WINDOW = LENGTH - GRAM + 1
_POSITION_BITS = np.uint64(28)
_POSITION = np.uint64((1 << 28) - 1)
PIECE = 1 << 20  # bytes hashed at once
#: Classes of one bucket that are refined in one task; a larger bucket takes the same steps, counted by Spark.
BUCKET_CLASSES = 8_000

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_BYTE = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def _geometric(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        steps = max(n, PIECE + LENGTH)
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(steps, base, np.uint64)
            row[0] = 1
            _powers[at : at + 1] = [np.cumprod(row, dtype=np.uint64)]
    return _powers[0], _powers[1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :])


def runs(buffer: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the texts that end at ``ends`` in the buffer: text number, q-gram hash, hash of the whole run,
    start of the first window in the buffer, offset of the anchor in that window, number of windows."""
    n = len(buffer)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    power, inverse = _geometric(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[buffer] * power[:n], out=sums[1:])
    grams = (sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1]
    order = (_mixed(grams) >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
    anchor = (_sliding_min(order, _PER_WINDOW) & _POSITION).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(ends, starts, side="right")
    inside = np.flatnonzero(starts + LENGTH <= ends[text])
    if not len(inside):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none, none
    own = anchor[inside]
    cut = np.flatnonzero((np.diff(inside) != 1) | (own[1:] != own[:-1])) + 1
    first, last = inside[np.append(0, cut)], inside[np.append(cut, len(inside)) - 1]
    at = own[np.append(0, cut)]
    whole = _mixed((sums[last + LENGTH] - sums[first]) * inverse[first])
    return text[first], grams[at], whole, first, at - first, last - first + 1


def _utf8(column: pa.Array) -> Iterator[bytes]:
    """Texts as UTF-8, one at a time: a batch is not held once more as Python strings."""
    return (t.as_py() for t in column.cast(pa.binary()))


def _pieces(texts: Iterable[bytes]) -> Iterator[tuple[list[int], list[int], np.ndarray, np.ndarray]]:
    """Texts joined to buffers of about ``PIECE`` bytes; a longer text is cut into pieces that overlap so
    that each window lies in exactly one. Yields text numbers, offsets in them, the buffer and its ends."""
    numbers, offsets, parts, size = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), PIECE):
            part = text[at : at + PIECE + LENGTH - 1]
            numbers.append(i)
            offsets.append(at)
            parts.append(part)
            size += len(part)
            if size >= PIECE:
                yield numbers, offsets, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])
                numbers, offsets, parts, size = [], [], [], 0
    if parts:
        yield numbers, offsets, np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(p) for p in parts])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``g`` (q-gram), ``c`` (run), ``ref`` (document), ``place``: start << 16 | anchor offset << 8 | windows - 1."""
    for batch in batches:
        refs = batch.column("ref").to_numpy()
        for numbers, offsets, buffer, ends in _pieces(_utf8(batch.column("text"))):
            text, gram, whole, first, offset, count = runs(buffer, ends)
            begins = ends - np.diff(ends, prepend=0)
            start = first - begins[text] + np.array(offsets)[text]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(refs[np.array(numbers)[text]]),
                 pa.array((start << 16) | (offset << 8) | (count - 1))],
                names=["g", "c", "ref", "place"],
            )


def _ids(values: np.ndarray) -> np.ndarray:
    """Bucket identifiers, -1 for a bucket of one and for what was dropped before."""
    out = np.full(len(values), -1, np.int64)
    live = np.flatnonzero(values >= 0)
    live = live[np.argsort(values[live])]
    ordered = values[live]
    first = np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)]
    alone = first & np.append(first[1:], True)[: len(ordered)]
    out[live] = np.where(alone, -1, np.cumsum(first))
    return out


def refined(contexts: list[bytes], windows: list[int]) -> list[np.ndarray]:
    """For each context, which of its windows (numbers from 0) start a string found in another context."""
    lengths = np.array([len(c) for c in contexts])
    ends = np.cumsum(lengths)
    buffer = np.frombuffer(b"".join(contexts), np.uint8)
    n = len(buffer)
    # a gram is short, so its hash is summed byte by byte: no powers as long as the buffer are held
    grams = np.zeros(max(0, n - STEP + 1), np.uint64)
    for j in range(STEP):
        grams *= np.uint64(_BASE)
        grams += _BYTE[buffer[j : j + len(grams)]]
    owner = np.repeat(np.arange(len(contexts), dtype=np.int32), lengths)
    ids = np.full(n, -1, np.int64)
    ids[: len(grams)] = (_mixed(grams) >> np.uint64(1)).view(np.int64)
    del grams
    ids[: n - STEP + 1][owner[: n - STEP + 1] != owner[STEP - 1 :]] = -1
    ids = _ids(ids)
    span = STEP
    while span < LENGTH:
        pair = np.full(n, -1, np.int64)
        now, later = ids[:-span], ids[span:]
        live = np.flatnonzero((now >= 0) & (later >= 0) & (owner[:-span] == owner[span:]))
        pair[live] = now[live] * (n + 1) + later[live]
        ids, span = _ids(pair), 2 * span
    begins = ends - lengths
    return [np.flatnonzero(ids[b : b + w] >= 0) for b, w in zip(begins, windows)]


def _spans(found: np.ndarray) -> list[int]:
    """Window numbers as runs: first << 8 | last."""
    cut = np.flatnonzero(np.diff(found) != 1) + 1
    first, last = found[np.append(0, cut)], found[np.append(cut, len(found)) - 1]
    return ((first << 8) | last).tolist()


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and class to the spans of classes with one run that are partly repeated."""
    schema = pa.schema([("g", pa.int64()), ("c", pa.int64()), ("shape", pa.int64()), ("spans", pa.list_(pa.int32()))])
    held: list[tuple] = []

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [
            (g, c, shape, _spans(found))
            for (g, c, shape, n, _), found in zip(held, refined([h[4] for h in held], [(h[2] & 255) + 1 for h in held]))
            if n == 1 and len(found)
        ]
        held.clear()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), schema.types)], schema=schema)

    for batch in batches:
        for row in zip(*(batch.column(x).to_pylist() for x in ("g", "c", "shape", "n", "bytes"))):
            if held and row[:3] == held[-1][:3]:
                continue  # the same class from a repeated row
            if len(held) >= 4_000 and row[0] != held[-1][0]:
                yield from flush()
            held.append(row)
    if held:
        yield from flush()


def _pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per window of a class: its number and the identifier of its bucket after the last step.

    The steps are those of ``refined``, with a hash of (bucket, later bucket) as the identifier of the refined one.
    """
    for batch in batches:
        for g, c, shape, context in zip(*(batch.column(x).to_pylist() for x in ("g", "c", "shape", "bytes"))):
            buffer = np.frombuffer(context, np.uint8)
            power, inverse = _geometric(len(buffer) + 1)
            sums = np.zeros(len(buffer) + 1, np.uint64)
            np.cumsum(_BYTE[buffer] * power[: len(buffer)], out=sums[1:])
            at = np.arange(len(buffer) - STEP + 1)
            bucket, span = _mixed((sums[at + STEP] - sums[at]) * inverse[at]), STEP
            while span < LENGTH:
                bucket, span = _mixed(_mixed(bucket[:-span]) * np.uint64(_BASE) + bucket[span:]), 2 * span
            full = lambda x: pa.array(np.full(len(bucket), x, np.int64))
            yield pa.RecordBatch.from_arrays(
                [full(g), full(c), full(shape), pa.array(np.arange(len(bucket), dtype=np.int32)), pa.array(bucket.view(np.int64))],
                names=["g", "c", "shape", "number", "bucket"],
            )


def _large_buckets(contexts: DataFrame) -> DataFrame:
    """The result of ``_refine`` for buckets of any size: identifiers by the same steps, counted by Spark."""
    owner = ["g", "c", "shape"]
    classes = contexts.select(*owner, "bytes").dropDuplicates(owner)
    windows = classes.mapInArrow(_pointed, "g long, c long, shape long, number int, bucket long")
    repeated = windows.groupBy("g", "bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("g", "bucket")
    found = windows.join(repeated, ["g", "bucket"]).groupBy(*owner).agg(F.sort_array(F.collect_list("number")).alias("found"))
    single = contexts.filter("n = 1").select(*owner).distinct()
    spans = F.transform("found", lambda x: F.shiftleft(x, 8).bitwiseOR(x).cast("int"))
    return found.join(single, owner).select(*owner, spans.alias("spans"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = [packer.compress(t) for t in _utf8(batch.column("text"))]
        columns = [batch.column(i) for i in range(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(packed, pa.binary())], names=[*batch.schema.names[:-1], "z"])


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("g", "c", "shape", "n", "k", "bytes")
    for batch in batches:
        rows = []
        for z, wanted in zip(batch.column("z").to_pylist(), batch.column("wanted").to_pylist()):
            text = zstandard.decompress(z) if z else b""
            for w in wanted:
                start, shape = w["place"] >> 16, w["place"] & 0xFFFF
                rows.append((w["g"], w["c"], shape, w["n"], w["k"], text[start : start + (shape & 255) + LENGTH]))
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> list[bytes]:
    """The pieces of a text outside sorted, disjoint spans."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
    return [*out, text[at:]]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, z, n, spans in zip(*(batch.column(x).to_pylist() for x in ("doc_id", "z", "n_bytes", "spans"))):
            merged = [(s["start"], s["end"]) for s in spans or ()]
            digest = hashlib.sha256()
            for piece in kept_bytes(zstandard.decompress(z) if z and n else b"", merged):
                digest.update(piece)
            rows.append((doc, n, sum(e - s for s, e in merged), len(merged), digest.hexdigest()))
        if rows:
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )


def _referred(documents: DataFrame) -> DataFrame:
    """``ref, doc_id, text``: the id where ids are unique and not null, else a hash of id and text."""
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    clash = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    ref = F.col("doc_id") if clash.isEmpty() else F.xxhash64("doc_id", "text")
    return docs.select(ref.alias("ref"), "doc_id", "text")


def repeated_spans(docs: DataFrame, bucket_classes: int = BUCKET_CLASSES) -> DataFrame:
    """``ref, spans``: per document with repeated strings the merged byte spans to remove, sorted.

    ``docs`` has ``ref`` and ``text`` (not null). Every exchange carries hashes and places, except one
    that carries the compressed texts to cut out the bytes around anchors of buckets with several classes.
    """
    anchors = docs.select("ref", "text").mapInArrow(_anchors, "g long, c long, ref long, place long")
    repeated = stored(anchors.groupBy("g").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("g"), "suffix-buckets")
    members = stored(anchors.join(repeated, "g", "left_semi"), "suffix-members")
    shape = F.col("place").bitwiseAND(F.lit(0xFFFF))
    classes = stored(
        members.groupBy("g", "c", shape.alias("shape")).agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("ref", "place")).alias("first")
        ).select("g", "c", "shape", "n", "first.*"),
        "suffix-classes",
    )
    buckets = classes.groupBy("g").agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).filter("k > 1 and least = 1")
    wanted = classes.join(buckets.select("g", "k"), "g").groupBy("ref").agg(
        F.collect_list(F.struct("g", "c", "place", "n", "k")).alias("wanted")
    )
    texts = docs.select("ref", "text").mapInArrow(_packed, "ref long, z binary")
    contexts = texts.join(wanted, "ref").select("z", "wanted").mapInArrow(
        _cut_contexts, "g long, c long, shape long, n long, k long, bytes binary"
    )
    largest = classes.groupBy("g").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).first()[0] or 0
    small = contexts.filter(F.col("k") <= bucket_classes)
    partly = small.repartition("g").sortWithinPartitions("g", "c", "shape").mapInArrow(
        _refine, "g long, c long, shape long, spans array<int>"
    )
    if largest > bucket_classes:
        partly = partly.unionByName(_large_buckets(contexts.filter(F.col("k") > bucket_classes)))
    whole = classes.filter("n > 1").select("g", "c", "shape", F.array(F.col("shape").bitwiseAND(F.lit(255)).cast("int")).alias("spans"))
    verdicts = stored(whole.unionByName(partly), "suffix-verdicts")
    start = F.shiftright("place", 16)
    found = members.withColumn("shape", shape).join(verdicts, ["g", "c", "shape"]).select("ref", F.explode(F.transform(
        "spans", lambda s: F.struct(
            (start + F.shiftright(s, 8)).alias("start"), (start + s.bitwiseAND(F.lit(255)) + LENGTH).alias("end")
        )
    )).alias("s"))
    return found.groupBy("ref").agg(F.sort_array(F.collect_set("s")).alias("spans")).select("ref", _merged("spans").alias("spans"))


def _merged(spans: str) -> Column:
    """Sorted spans with those that overlap or touch made one."""
    kind = "array<struct<start:bigint,end:bigint>>"

    def add(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(
            F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        ))
        return F.when(F.size(acc) == 0, F.array(s)).when(s["start"] <= last["end"], joined).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(F.col(spans).cast(kind), F.lit([]).cast(kind), add)


def deduplicated(documents: DataFrame, bucket_classes: int = BUCKET_CLASSES) -> DataFrame:
    """Per row of ``documents``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (of the bytes kept).

    Whole texts are taken as UTF-8 bytes, null as empty; matches never cross documents; a string repeated
    within one document counts. Texts under 200 bytes keep everything. Rows equal in id and text are
    repeats of each other. Other columns are not read.
    """
    docs = _referred(documents)
    spans = stored(repeated_spans(docs, bucket_classes), "suffix-spans")
    packed = docs.select("ref", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text").mapInArrow(
        _packed, "ref long, doc_id long, n_bytes long, z binary"
    )
    return packed.join(spans, "ref", "left").select("doc_id", "z", "n_bytes", "spans").mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
