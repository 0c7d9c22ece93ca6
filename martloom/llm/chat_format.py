"""Chat formatting with a grammar round trip.

Template, one turn after another:  ``<|im_start|>ROLE\\nTEXT<|im_end|>\\n``

A deterministic parser reads rendered text back; a turn mark inside a role or text is off its grammar, and
so is a line-break mark inside a text. A turn that is off the grammar, or whose recovered role and text
differ from the source, is escaped and rendered anew until they are identical: the escape puts one more
backslash between ``<`` and ``|``, reading takes one away, so escaped text never holds a control string.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

OPEN, CLOSE, END = "<|im_start|>", "<|im_end|>", "\n"
LINE = "<|n|>"  # a line break inside a role
_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
MAX_CHARS = 16_000_000

FORMAT_SCHEMA = (
    "conv_id long, part int, formatted string, n_turns long, loss_starts array<int>, loss_ends array<int>"
)
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


class GrammarError(ValueError):
    pass


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def turns_of(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role, text, and where the (escaped) text starts and ends; ``GrammarError`` off the grammar."""
    at = 0
    while at < len(formatted):
        if not formatted.startswith(OPEN, at):
            raise GrammarError(f"no turn opens at {at}")
        line = formatted.find("\n", at)
        end = formatted.find(CLOSE, line)
        if line < 0 or end < 0 or not formatted.startswith(END, end + len(CLOSE)):
            raise GrammarError(f"the turn at {at} does not close")
        head, body = formatted[at + len(OPEN) : line], formatted[line + 1 : end]
        if OPEN in head or CLOSE in head or OPEN in body or LINE in body:
            raise GrammarError(f"a control string inside the turn at {at}")
        yield unescape(head.replace(LINE, "\n")), unescape(body), line + 1, end
        at = end + len(CLOSE) + len(END)


def recovered(formatted: str) -> list[tuple[str, str]] | None:
    try:
        return [(role, text) for role, text, _, _ in turns_of(formatted)]
    except GrammarError:
        return None


def _piece(head: str, body: str) -> tuple[str, int]:
    return f"{OPEN}{head}\n{body}{CLOSE}{END}", len(OPEN) + len(head) + 1


def settled(role: str, text: str) -> tuple[str, str]:
    """Role and text as they go into the template, escaped only as far as the round trip asks for."""
    raw, escaped = (role, text), (escape(role).replace("\n", LINE), escape(text))
    for head, body in (raw, escaped):
        if recovered(_piece(head, body)[0]) == [(role, text)]:
            return head, body
    raise GrammarError("an escaped turn does not read back")


def render_turn(role: str, text: str) -> tuple[str, int]:
    """The rendered turn and the offset of its text."""
    return _piece(*settled(role, text))


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns with ``head`` and ``body`` where the escaped form differs from the raw one, null elsewhere."""
    for batch in batches:
        pairs = []
        for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
            raw = (role or "", text or "")
            pair = settled(*raw)
            pairs.append((None, None) if pair == raw else pair)
        heads, bodies = zip(*pairs) if pairs else ((), ())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(heads, pa.string()), pa.array(bodies, pa.string())],
            names=[*batch.schema.names, "head", "body"],
        )


def _rendered(batches: Iterator[pa.RecordBatch], max_chars: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn to one row per conversation, or per part of a huge one."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()), ("n_turns", pa.int64()),
         ("loss_starts", pa.list_(pa.int32())), ("loss_ends", pa.list_(pa.int32()))]
    )
    rows: list[tuple] = []
    conv, part, started = None, 0, False
    pieces: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    length = held = 0

    def close() -> None:
        nonlocal pieces, starts, ends, length, held
        rows.append((conv, part, "".join(pieces), len(pieces), starts, ends))
        held += length
        pieces, starts, ends, length = [], [], [], 0

    def flush() -> pa.RecordBatch:
        nonlocal rows, held
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
        rows, held = [], 0
        return out

    for batch in batches:
        columns = ("conv_id", "role", "text", "head", "body")
        for key, role, text, head, body in zip(*(batch.column(c).to_pylist() for c in columns)):
            if not started or key != conv:
                if started:
                    close()
                conv, part, started = key, 0, True
            piece, offset = _piece(role or "", text or "") if head is None else _piece(head, body)
            if pieces and length + len(piece) > max_chars:
                close()
                part += 1
            if role == "assistant":
                starts.append(length + offset)
                ends.append(length + len(piece) - len(CLOSE) - len(END))
            pieces.append(piece)
            length += len(piece)
            if held > 4_000_000 or len(rows) >= 2_000:
                yield flush()
    if started:
        close()
    if rows:
        yield flush()


def format_conversations(df: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """One row per conversation: its text in the template and the spans under the loss mask.

    Rows of a conversation are ordered by turn, ties by role and text, a null turn first; a null role or
    text is empty; rows without ``conv_id`` form one conversation. Turns are rendered, read back and
    escaped in the tasks that read them; one task per conversation sorts and joins them. Its rows are
    streamed in order, so memory holds one part at a time: a conversation of more than ``max_chars`` is
    returned in several parts that break between turns, numbered from 0. Other columns are not read.
    """
    turns = df.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    fields = StructType([*turns.schema.fields, StructField("head", StringType()), StructField("body", StringType())])
    ordered = turns.mapInArrow(_settled, fields).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(lambda batches: _rendered(batches, max_chars), FORMAT_SCHEMA)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    conv, state = None, None
    rows: list[tuple] = []

    def close() -> None:
        n, turns, chars, loss, total = state
        rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), total))

    for batch in batches:
        columns = ("conv_id", "part", "formatted", "loss_starts", "loss_ends")
        for key, part, text, starts, ends in zip(*(batch.column(c).to_pylist() for c in columns)):
            if part == 0:
                if state is not None:
                    close()
                conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, body, _, _ in turns_of(text):
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
            for start, end in zip(starts, ends):
                body = unescape(text[start:end])
                state[2] += len(body)
                state[3].update(body.encode())
            state[4] += len(text)
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))
            rows = []
    if state is not None:
        close()
        yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows)))))


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What the formatted text holds, read by the parser: turns, and the text under the loss mask.

    Takes the rows of ``format_conversations``, whose parts follow each other within a partition.
    """
    return formatted.mapInArrow(_read_back, DIGEST_SCHEMA)
