"""Collocations by Toivonen's mining: a sample proposes, full passes count proposals and their border.

A sample of the pieces (every eighth by hash, so it grows with the corpus) is mined level by level at a
lowered support. The full count then covers each phrase whose two parts one word shorter were both proposed:
these are the proposals and their negative border. A border phrase that turns out frequent is a failure of the
sample; it joins the proposals, and a further pass counts only what thereby came into reach, until no failure is
left. Then every frequent phrase has been counted, whatever the sample held.

Most of the border is rare, so the full count first adds up 64-bit hashes in place of spelled phrases. A hash
that stays below the support proves its phrases infrequent (phrases that share a hash only raise its sum); all
others are counted exactly, as spelled, over the whole corpus. These other hashes then stand in for the proposals:
they have all that is frequent among them and the failures of the border, so the pass that counts as spelled also
counts what those failures bring into reach, and extends nothing that is known to be rare. Later passes read only
pieces that hold a failure.

Proposals and hashes are held in bit filters of fixed size, so what travels to the tasks does not grow with the corpus.
A phrase that a filter holds by mistake is merely counted too; no result depends on it. Counts go through the shuffle in
arrays, one for each value of the first bits of the hash, and not as a row each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.llm.tables import LOWER, UPPER, stored

LEAST, LONGEST, TOP = 30, 4, 2000
#: One piece in so many is sampled, and mined at this part of the support expected there.
SAMPLE, SLACK = 8, 0.5
#: Bits of the filter (16 MB).
FILTER_BITS = 1 << 27
#: Rows sent at once to the JVM, which holds a batch as a whole.
BATCH = 20_000
#: Hashes that a task adds up before it sends them; of spelled phrases the bytes that as many hashes and counts take.
PACKED = 1 << 21
#: Bytes of text counted at once; longer stretches are cut between pieces.
CHUNK = 1 << 19

#: Counts by hash: its first 16 bits, the 6 bytes of each one's other bits, and the count of each.
PACKS = "first int, rest binary, counts binary"
#: Counts as spelled: the first 12 bits of the hash, the phrases with a line break after each, their hashes and counts.
SPELLED = "lang string, first int, phrases binary, hashes binary, counts binary"
ROWS = "lang string, n int, phrase string, h long, known boolean, f long"

_GOLDEN, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[[ord(c) for c in UPPER]] = [ord(c) for c in LOWER]
#: 0 a word's byte, 1 a blank, 2 the end of a piece.
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


@dataclass(frozen=True)
class Filter:
    """A set of phrase hashes that may hold more than was put in, never less."""

    bits: np.ndarray

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for part in (h, h >> np.uint64(32)):
            at = (part & np.uint64(len(self.bits) * 8 - 1)).astype(np.int64)
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out

    def has_any(self, h: np.ndarray) -> np.ndarray:
        """Whether one of the two bits of a hash is there."""
        out = np.zeros(len(h), bool)
        for part in (h, h >> np.uint64(32)):
            at = (part & np.uint64(len(self.bits) * 8 - 1)).astype(np.int64)
            out |= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def _cuts(breaks: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Stretches of about ``CHUNK`` bytes that end after the end of a piece."""
    low = 0
    while low < size:
        k = np.searchsorted(breaks, low + CHUNK)
        high = int(breaks[k]) + 1 if k < len(breaks) and low + CHUNK < size else size
        yield low, high
        low = high


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive texts of about ``CHUNK`` bytes together (or one longer text), each slice with its first index."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(texts):
        limit = (ends[low - 1] if low else 0) + CHUNK
        high = max(low + 1, int(np.searchsorted(ends, limit, "right")))
        yield low, texts.slice(low, high - low)
        low = high


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each followed by a line break; and where each ends."""
    texts = texts.cast(pa.large_string())
    _, ends, values = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    values = np.frombuffer(values, np.uint8)[ends[0] : ends[-1]] if values else np.zeros(0, np.uint8)
    closes = ends[1:] - ends[0]
    return np.insert(values, closes, 10), closes + np.arange(len(closes))


def _words(text: np.ndarray, kind: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of a stretch, where each starts, and the number of its piece."""
    inside = kind == 0
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    starts = np.flatnonzero(edge == 1)
    lengths = np.flatnonzero(edge == -1) - starts
    ends = np.concatenate([[0], np.cumsum(lengths)])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(text[inside]))
    return words, starts, np.searchsorted(np.flatnonzero(kind == 2), starts)


def _hashes(words: pa.Array, seeds: np.ndarray) -> np.ndarray:
    """64 bits per word: its bytes as digits of a polynomial, mixed with a seed per word."""
    if not len(words):
        return np.zeros(0, np.uint64)
    words = words.cast(pa.large_binary())
    _, ends, values = words.buffers()
    ends = np.frombuffer(ends, np.int64)[words.offset : words.offset + len(words) + 1]
    digits = np.frombuffer(values, np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
    starts, lengths = ends[:-1] - ends[0], np.diff(ends)
    powers = np.cumprod(np.full(int(lengths.max()), _MIX1, np.uint64))
    digits *= powers[np.arange(len(digits)) - np.repeat(starts, lengths)]
    return _mixed(np.add.reduceat(digits, starts) + seeds)


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, and the index of each code among them."""
    encoded = pa.array(codes).dictionary_encode()
    return encoded.dictionary.to_numpy(), encoded.indices.to_numpy().astype(np.int64)


def _unpacked(sent: Broadcast) -> Filter:
    return Filter(np.frombuffer(zlib.decompress(sent.value), np.uint8))


@dataclass
class Level:
    """The distinct phrases of ``n`` words in a stretch: language, indexes of the words, hash, whether the filter
    has it, occurrences, and whether it came into reach."""

    n: int
    lang: np.ndarray
    spelling: np.ndarray
    h: np.ndarray
    known: np.ndarray
    count: np.ndarray
    wanted: np.ndarray


def _levels(
    words: pa.Array, langs: np.ndarray, piece: np.ndarray, names: list[str], new: Filter, old: Filter | None
) -> Iterator[tuple[pa.Array, Level]]:
    """Phrases by length within reach of ``new``, with the distinct words that their indexes mean.

    Words are within reach of any filter, longer phrases where both parts one word shorter are and the filter has them;
    wanted are those that were not within reach of ``old`` (None: nothing was). That ``old`` has a part by mistake does
    not mean it was reached. Codes of phrases are exact within a stretch.
    """
    encoded = words.dictionary_encode()
    spelled = encoded.dictionary
    codes, gram = _distinct(langs * len(spelled) + encoded.indices.to_numpy())
    lang, word = codes // max(1, len(spelled)), codes % max(1, len(spelled))
    seeds = _hashes(pa.array([f"{name}/" for name in names], pa.large_string()), np.zeros(len(names), np.uint64))
    h = _hashes(spelled, np.zeros(len(spelled), np.uint64))[word]
    h = _mixed(h + seeds[lang])
    spelling, last, at = word[:, None], h, np.arange(len(gram))
    reached = np.full(len(codes), old is not None)
    for n in range(1, LONGEST + 1):
        known = new.has(h)
        yield spelled, Level(n, lang, spelling, h, known, np.bincount(gram, minlength=len(codes)), ~reached)
        if n == LONGEST:
            return
        before = reached & old.has(h) if old else reached
        stay = known[gram]
        at, gram = at[stay], gram[stay]
        on = np.flatnonzero((at[1:] == at[:-1] + 1) & (piece[at[1:]] == piece[at[:-1]]))
        codes, joined = _distinct(gram[on] * len(h) + gram[on + 1])
        if not len(codes):
            return
        head, tail = codes // len(h), codes % len(h)
        reached = before[head] & before[tail]
        h = _mixed(h[head] * _GOLDEN + last[tail] + np.uint64(n))
        spelling, last, lang = np.hstack([spelling[head], spelling[tail, -1:]]), last[tail], lang[head]
        at, gram = at[on], joined


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, list[str]]]:
    """Stretches of text that hold a word: their words, language and piece of each, and language names."""
    for batch in batches:
        if not batch.num_rows:
            continue
        encoded = batch.column("lang").dictionary_encode()
        names, of_text = encoded.dictionary.to_pylist(), encoded.indices.to_numpy().astype(np.int64)
        for first, some in _slices(batch.column("text")):
            text, ends = _bytes(some)
            for low, high in _cuts(np.flatnonzero(_KIND[text] == 2), len(text)):
                part = _LOWERED[text[low:high]]
                words, starts, piece = _words(part, _KIND[part])
                if len(words):
                    yield words, of_text[first + np.searchsorted(ends, starts + low)], piece, names


def _added_up(h: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, and the sum of each."""
    order = np.argsort(h)
    h, f = h[order], f[order]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    return h[starts], np.add.reduceat(f, starts) if len(h) else f


def _binaries(values: np.ndarray, starts: np.ndarray, width: int) -> pa.Array:
    """Consecutive parts of an array, each with ``width`` bytes a value."""
    ends = np.append(starts, len(values)) * width
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values.tobytes())])


def _packs(h: np.ndarray, f: np.ndarray, least: int) -> Iterator[pa.RecordBatch]:
    """Hashes in order and their counts as ``PACKS``. A count beyond ``least`` says no more than ``least`` does."""
    first = (h >> np.uint64(48)).astype(np.int32)
    starts = np.flatnonzero(np.diff(first, prepend=-1))
    rest = h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]
    counts = np.minimum(f, least).astype(np.min_scalar_type(least))
    columns = [pa.array(first[starts]), _binaries(rest, starts, 6), _binaries(counts, starts, counts.itemsize)]
    rows = pa.RecordBatch.from_arrays(columns, names=["first", "rest", "counts"])
    for at in range(0, rows.num_rows, BATCH):
        yield rows.slice(at, BATCH)


def _of_packs(batch: pa.RecordBatch, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of ``PACKS`` and their counts."""
    rest = np.frombuffer(b"".join(batch.column("rest").to_pylist()), np.uint8).reshape(-1, 6)
    h = np.zeros((len(rest), 8), np.uint8)
    h[:, :6] = rest
    sizes = pc.binary_length(batch.column("rest")).to_numpy() // 6
    h = h.view("<u8").ravel() | (np.repeat(batch.column("first").to_numpy().astype(np.uint64), sizes) << np.uint64(48))
    return h, np.frombuffer(b"".join(batch.column("counts").to_pylist()), np.min_scalar_type(least)).astype(np.int64)


def _often(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Hashes whose counts add up to ``least``, from ``PACKS`` in order. Few values of the first bits are held at once."""
    def sent(h: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        h, f = _added_up(h, f)
        yield pa.RecordBatch.from_arrays([pa.array(h[f >= least].view(np.int64))], names=["h"])

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(_of_packs(batch, least))
        size += len(held[-1][0])
        if size >= PACKED:
            h, f = (np.concatenate(x) for x in zip(*held))
            first = h >> np.uint64(48)
            whole = int(np.searchsorted(first, first[-1]))  # the last value may go on in the next batch
            if whole:
                yield from sent(h[:whole], f[:whole])
            held = [_added_up(h[whole:], f[whole:])]
            size = len(held[0][0])
    if held:
        yield from sent(*(np.concatenate(x) for x in zip(*held)))


def _hash_counts(
    batches: Iterator[pa.RecordBatch], new: Broadcast, old: Broadcast | None, least: int
) -> Iterator[pa.RecordBatch]:
    """Hashes within reach and their counts, added up over many stretches."""
    now, before = _unpacked(new), _unpacked(old) if old else None
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def added() -> Iterator[pa.RecordBatch]:
        h, f = (np.concatenate(x) for x in zip(*held))
        held.clear()
        yield from _packs(*_added_up(h, f), least)

    size = 0
    for words, langs, piece, names in _stretches(batches):
        for _, level in _levels(words, langs, piece, names, now, before):
            if level.wanted.any():
                held.append((level.h[level.wanted], level.count[level.wanted]))
                size += len(held[-1][0])
        if size >= PACKED:
            yield from added()
            size = 0
    if held:
        yield from added()


def _likely_hashes(texts: DataFrame, new: Broadcast, old: Broadcast | None, least: int) -> DataFrame:
    """``h``: hashes of all phrases that came into reach and occur ``least`` times, and few others."""
    packs = texts.mapInArrow(lambda b: _hash_counts(b, new, old, least), PACKS)
    return packs.repartition("first").sortWithinPartitions("first").mapInArrow(lambda b: _often(b, least), "h long")


def _rows(langs: pa.Array, phrases: pa.Array, h: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
    columns = [langs, phrases, pa.array(h.view(np.int64)), pa.array(f.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "h", "f"])


def _sent(spark: SparkSession, bits: np.ndarray) -> Broadcast:
    """The filter to every task: its fixed size at most, far less while it is sparse."""
    return spark.sparkContext.broadcast(zlib.compress(bits, 1))


def _rows_added_up(rows: pa.Table) -> pa.Table:
    """Rows of the same phrase added up. More threads would each hold groups of their own."""
    total = rows.group_by(["lang", "phrase", "h"], use_threads=False).aggregate([("f", "sum")])
    return total.select(["lang", "phrase", "h", "f_sum"]).rename_columns(["lang", "phrase", "h", "f"]).combine_chunks()


def _spelled_packs(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows added up, as ``SPELLED``. No phrase has a line break: it ends a piece."""
    total = _rows_added_up(pa.Table.from_batches(held))
    held.clear()
    langs, phrases = (total[c].chunk(0) for c in ("lang", "phrase"))
    h, f = total["h"].to_numpy().view(np.uint64), total["f"].to_numpy()
    first, of = (h >> np.uint64(52)).astype(np.int32), langs.dictionary_encode().indices.to_numpy().astype(np.int64)
    order = np.argsort(of << 12 | first, kind="stable")
    starts = np.flatnonzero(np.diff((of << 12 | first)[order], prepend=-1))
    lines = pc.binary_join_element_wise(phrases.take(pa.array(order)).cast(pa.binary()), b"", b"\n")
    _, ends, values = lines.buffers()
    ends = np.frombuffer(ends, np.int32)[lines.offset : lines.offset + len(lines) + 1]
    lines = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends[np.append(starts, len(lines))]), values])
    columns = [
        langs.take(pa.array(order[starts])), pa.array(first[order[starts]]), lines,
        _binaries(h[order].astype("<u8"), starts, 8), _binaries(f[order].astype("<i8"), starts, 8),
    ]
    rows = pa.RecordBatch.from_arrays(columns, names=["lang", "first", "phrases", "hashes", "counts"])
    for at in range(0, rows.num_rows, BATCH):
        yield rows.slice(at, BATCH)


def _of_spelled(batch: pa.RecordBatch) -> tuple[pa.Table, np.ndarray]:
    """The rows of ``SPELLED``, and the first bits of each."""
    lines, hashes, counts = (b"".join(batch.column(c).to_pylist()) for c in ("phrases", "hashes", "counts"))
    text = np.frombuffer(lines, np.uint8)
    ends = np.flatnonzero(text == 10)
    ends = np.append(0, ends - np.arange(len(ends)))
    phrases = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(text[text != 10]))
    pack = np.repeat(np.arange(batch.num_rows), pc.binary_length(batch.column("hashes")).to_numpy() // 8)
    columns = [
        batch.column("lang").take(pa.array(pack)), phrases, pa.array(np.frombuffer(hashes, "<i8")),
        pa.array(np.frombuffer(counts, "<i8")),
    ]
    return pa.table(columns, names=["lang", "phrase", "h", "f"]), batch.column("first").to_numpy()[pack]


def _often_spelled(batches: Iterator[pa.RecordBatch], new: Broadcast, least: int) -> Iterator[pa.RecordBatch]:
    """``ROWS`` whose counts add up to ``least``, and those of no words, from ``SPELLED`` in order of the first bits."""
    now = _unpacked(new)

    def sent(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = _rows_added_up(rows)
        words = pc.if_else(pc.equal(rows["phrase"], ""), 0, pc.add(pc.count_substring(rows["phrase"], " "), 1))
        rows = rows.append_column("n", words.cast(pa.int32()))
        rows = rows.filter(pc.or_(pc.greater_equal(rows["f"], least), pc.equal(rows["n"], 0)))
        known = pa.array(now.has(rows["h"].to_numpy().view(np.uint64)))
        columns = [rows["lang"], rows["n"], rows["phrase"].cast(pa.string()), rows["h"], known, rows["f"]]
        yield from pa.table(columns, names=["lang", "n", "phrase", "h", "known", "f"]).to_batches(BATCH)

    held: list[tuple[pa.Table, np.ndarray]] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(_of_spelled(batch))
        size += held[-1][0].nbytes
        if size >= PACKED * 16:
            rows, first = pa.concat_tables(t for t, _ in held), np.concatenate([x for _, x in held])
            whole = int(np.searchsorted(first, first[-1]))  # the last value may go on in the next batch
            if whole:
                yield from sent(rows.slice(0, whole))
            rest = _rows_added_up(rows.slice(whole))
            held, size = [(rest, np.full(len(rest), first[-1]))], rest.nbytes
    if held:
        yield from sent(pa.concat_tables(t for t, _ in held))
    held.clear()
    pa.default_memory_pool().release_unused()


def _near(
    words: pa.Array, langs: np.ndarray, piece: np.ndarray, names: list[str], new: Filter, old: Filter, added: Filter
) -> np.ndarray:
    """Whether the piece of each word holds a phrase that ``new`` has and ``old`` has not; ``added`` has only the new bits.

    All shorter parts of a phrase within reach of ``new`` are in ``new``; if it was not within reach of ``old``, one of
    them is not in ``old``. So other pieces hold no phrase that came into reach.
    """
    encoded = words.dictionary_encode()
    seeds = _hashes(pa.array([f"{name}/" for name in names], pa.large_string()), np.zeros(len(names), np.uint64))
    spelled = _hashes(encoded.dictionary, np.zeros(len(encoded.dictionary), np.uint64))
    last = h = _mixed(spelled[encoded.indices.to_numpy()] + seeds[langs])
    held = np.zeros(int(piece[-1]) + 1, bool)
    for n in range(1, LONGEST):
        if n > 1:
            h = _mixed(h[:-1] * _GOLDEN + last[n - 1 :] + np.uint64(n - 1))
        some = np.flatnonzero(added.has_any(h))
        some = some[piece[some] == piece[some + n - 1]]
        held[piece[some[new.has(h[some]) & ~old.has(h[some])]]] = True
        if len(h) == 1:
            break
    return held[piece]


def _count_pass(
    batches: Iterator[pa.RecordBatch], new: Broadcast, old: Broadcast, first: bool
) -> Iterator[pa.RecordBatch]:
    """Counts of every stretch as spelled, of all that was not within reach of ``old``.

    The first pass also counts what was, where ``new`` has it; its rows of no words hold the number of words.
    """
    now, before = _unpacked(new), _unpacked(old)
    added = None if first else Filter(now.bits & ~before.bits)
    held, size = [], 0
    for words, langs, piece, names in _stretches(batches):
        if first:
            total, none = np.bincount(langs, minlength=len(names)), np.zeros(len(names), np.int64)
            held.append(_rows(pa.array(names), pa.array([""] * len(names)), none, total))
        else:
            near = _near(words, langs, piece, names, now, before, added)
            if not near.any():
                continue
            words, langs, piece = words.filter(pa.array(near)), langs[near], piece[near]
        for spelled, level in _levels(words, langs, piece, names, now, before):
            mine = level.wanted | level.known if first else level.wanted
            if not mine.any():
                continue
            parts = [spelled.take(pa.array(level.spelling[mine, j])) for j in range(level.n)]
            phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if level.n > 1 else parts[0]
            langs_of = pa.array(names).take(pa.array(level.lang[mine]))
            held.append(_rows(langs_of, phrase.cast(pa.string()), level.h[mine], level.count[mine]))
            size += held[-1].nbytes
        if size >= PACKED * 16:
            yield from _spelled_packs(held)
            size = 0
            pa.default_memory_pool().release_unused()  # what grouping took, which Arrow would keep for later tasks
    if held:
        yield from _spelled_packs(held)
    pa.default_memory_pool().release_unused()


def _sampled(batches: Iterator[pa.RecordBatch], one_in: int) -> Iterator[pa.RecordBatch]:
    """Of every text the pieces that a hash of the text and their number draws."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy().view(np.uint64)
        for first, some in _slices(batch.column("text")):
            text, ends = _bytes(some)
            closes = np.flatnonzero(_KIND[text] == 2)  # ends of pieces; the last of a text is its added line break
            of_text = np.searchsorted(ends, closes)
            begin = np.searchsorted(closes, np.concatenate([[0], ends[:-1] + 1]))
            number = (np.arange(len(closes)) - begin[of_text]).astype(np.uint64)
            drawn = _mixed(keys[first + of_text] + number * _GOLDEN) % np.uint64(one_in) == 0
            lengths = np.diff(np.concatenate([[-1], closes]))
            kept = text[np.repeat(drawn, lengths)].tobytes()
            sizes = np.bincount(of_text, np.where(drawn, lengths, 0), len(ends))
            taken = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            out = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(taken), pa.py_buffer(kept)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("lang").slice(first, len(ends)), out], names=["lang", "text"])


def _added(bits: np.ndarray, phrases: DataFrame) -> np.ndarray:
    """The filter with the hashes of ``phrases``. Tasks build its parts; its fixed size comes to the driver."""
    size = len(bits) * 8
    # Spark numbers the buckets of a bitmap from 1, for values from 1
    at = F.explode(F.array(*[F.shiftrightunsigned("h", s).bitwiseAND(F.lit(size - 1)) + 1 for s in (0, 32)])).alias("at")
    maps = phrases.select(at).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )
    out = bits.copy()
    for r in maps.toLocalIterator():  # at most size / 32,768 rows of 4 KB
        part = np.frombuffer(r["bits"], np.uint8)
        low = (r["bucket"] - 1) * len(part)
        out[low : low + len(part)] |= part[: len(out) - low]
    return out


def _proposed(sample: DataFrame, least: int, bits: np.ndarray) -> np.ndarray:
    """The filter of the sample's frequent phrases of up to ``LONGEST - 1`` words, mined a length at a time."""
    spark, old = sample.sparkSession, None
    for _ in range(LONGEST - 1):
        new = _sent(spark, bits)
        found = stored(_likely_hashes(sample, new, old, least), "phrase-proposals")
        if old is not None:
            old.destroy()
        old, bits = new, _added(bits, found)
    old.destroy()
    return bits


def _mined(texts: DataFrame, least: int, bits: np.ndarray) -> DataFrame:
    """``lang, n, phrase, f`` of every phrase found ``least`` times, and rows ``n = 0`` with the word counts.

    ``bits`` proposes. Hashes tell which proposals and border phrases may be frequent; the first pass counts these, and what
    they bring into reach. Every later pass counts what came into reach by the failures of the last; a
    failure has more words in each pass, so there are at most ``LONGEST`` passes.
    """
    spark, found = texts.sparkSession, []
    old = _sent(spark, bits)
    bits = _added(np.zeros_like(bits), stored(_likely_hashes(texts, old, None, least), "phrase-hashes"))
    while True:
        new = _sent(spark, bits)
        packs = texts.mapInArrow(lambda b, n=new, o=old, first=not found: _count_pass(b, n, o, first), SPELLED)
        packs = packs.repartition("first").sortWithinPartitions("first")
        frequent = stored(packs.mapInArrow(lambda b, n=new: _often_spelled(b, n, least), ROWS), "phrase-counts")
        found.append(frequent.drop("known", "h"))
        old.destroy()
        old, before = new, bits
        bits = _added(before, frequent.filter(~F.col("known") & F.col("n").between(1, LONGEST - 1)))
        if np.array_equal(bits, before):  # a failure is not in the filter, so it adds to it
            old.destroy()
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def frequent_phrases(documents: DataFrame, least: int = LEAST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, n, phrase, f``: the exact count of every phrase of 1 to ``LONGEST`` words found ``least`` times.

    A row with ``n = 0`` per language holds its number of words.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    texts = documents.select(lang, text)
    keyed = documents.select(lang, text, F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"))
    sample = stored(keyed.mapInArrow(lambda b: _sampled(b, SAMPLE), "lang string, text string"), "phrase-sample")
    none = np.zeros(filter_bits // 8, np.uint8)
    lowered = max(2, int(SLACK * least / SAMPLE))
    return _mined(texts, least, _proposed(sample, lowered, none))


def scored_phrases(counts: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score``: every phrase of two or more words at its lowest-scoring cut."""
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    words = counts.filter("n > 0").select("lang", "phrase", "f")
    cuts = counts.filter("n > 1").select("lang", "phrase", "n", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = cuts.select("*", F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k")).select(
        "lang", "phrase", "n", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("n") - F.col("k")), " ").alias("tail"),
    )
    heads = words.withColumnsRenamed({"phrase": "head", "f": "l"})
    tails = words.withColumnsRenamed({"phrase": "tail", "f": "r"})
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    both = both.withColumn("top", exact("a") * F.lit(2_000_000).cast("decimal(8,0)")).withColumn("sum", exact("l") + exact("r"))
    lowest = F.min(F.struct(F.expr("top div sum").alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "n", "a").agg(lowest).select(
        "lang", "phrase", F.col("n").alias("words"), "a", "cut.l", "cut.r", "cut.score"
    )


def _not_contained(scored: DataFrame) -> DataFrame:
    """Without phrases inside a longer one that occurs at least four fifths as often."""
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    longer = scored.filter("words > 2").select("lang", "a", "words", F.split("phrase", " ").alias("w"))
    inside = longer.select(
        "lang", "a", "words", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    ).select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("i"))
    most = inside.select("lang", F.array_join(F.slice("w", F.col("i"), F.col("size")), " ").alias("phrase"), "a")
    most = most.groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    covered = exact("longest") * 100 >= exact("a") * 80
    return scored.join(most, ["lang", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False))).drop("longest")


def collocations(documents: DataFrame, least: int = LEAST, top: int = TOP, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Null texts are empty, null languages ``und``; rows with a null ``doc_id`` and repeated rows count like any other.
    Texts are cut into stretches only where a piece ends, so a task holds the rows of an Arrow batch and
    the longest piece. A language with most of the rows is counted by all tasks and ranked from the first ``top`` of each.
    An empty table gives no rows; columns but ``doc_id``, ``text`` and ``lang`` are not read.
    """
    counts = stored(frequent_phrases(documents, least, filter_bits), "phrases")
    total = counts.filter("n = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    scored = stored(scored_phrases(counts), "scored-phrases")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = _not_contained(scored).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


SQL = rf"""
WITH p AS MATERIALIZED (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS MATERIALIZED (SELECT lang, k, x, count(*) AS f FROM (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS x
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k))) GROUP BY lang, k, x),
c AS MATERIALIZED (SELECT lang, k, x, f AS a, string_split(x, ' ') AS w FROM g WHERE k > 1 AND f >= {LEAST}),
cuts AS (SELECT c.lang, c.k, c.x, c.a, j, l.f AS l, r.f AS r, CAST(2000000 AS HUGEINT) * c.a // (l.f + r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
    JOIN g l ON l.lang = c.lang AND l.x = array_to_string(c.w[1 : j], ' ')
    JOIN g r ON r.lang = c.lang AND r.x = array_to_string(c.w[j + 1 : c.k], ' ')),
s AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, x ORDER BY score, j) = 1),
part AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS x, max(a) AS most FROM (
    SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL),
kept AS (SELECT s.* FROM s LEFT JOIN part USING (lang, x) WHERE most IS NULL OR 100 * most < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(x)) AS rank FROM kept)
SELECT lang, rank, x AS phrase, a, l, r, CAST(t.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang) t USING (lang) WHERE rank <= {TOP}
"""
