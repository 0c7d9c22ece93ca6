"""WARC archives with an index written first.

Writing: every task appends gzip members, one per record, to archive files of its own and returns one
index row per record (file, offset, length, URL, digest). Reading starts from the index: the selected
rows are sorted by file and offset, neighbouring byte ranges coalesce into one read, and each record is
cut out of the block by its offset.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_SCHEMA = "file string, offset long, length long, url string, record_id string, record_type string, digest string"
RECORD_SCHEMA = (
    "file string, offset long, record_id string, record_type string, url string, refers_to string, "
    "digest string, payload_bytes long, payload string"
)
MIN_REVISIT_BYTES = 1000
RECORD_DATE = "2024-01-01T00:00:00Z"


def revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, digest, payload_bytes, refers_to`` of every page.

    Of pages with equal payloads of at least ``min_bytes``, the largest ``page_id`` is the response and
    ``refers_to`` names it on the others. Rows that share that largest id are all responses. A null
    ``page_id`` ranks below any other; with no other, its rows are responses. A null html is empty.
    The groups are reduced to one row each before they meet the pages, so a payload shared by a third of
    all pages costs a skewed join, which Spark splits, and no task holds it.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumns({"digest": F.sha1(F.encode("html", "utf-8")), "payload_bytes": F.octet_length("html").cast("long")})
    groups = (
        rows.filter(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("digest").alias("g_digest"), F.col("payload_bytes").alias("g_bytes"))
        .agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    same = (F.col("digest") == F.col("g_digest")) & (F.col("payload_bytes") == F.col("g_bytes"))
    return rows.join(groups, same, "left").select(
        "page_id", "url", "html", "digest", "payload_bytes",
        F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")).alias("refers_to"),
    )


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _line(value: str | None) -> str:
    """A header value on one line: control characters and spaces, which no URI holds, are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def _qualified(spark: SparkSession, folder: str) -> str:
    """The folder with its scheme: without one it belongs to the cluster's default file system, as Spark has it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/+", "file:///", whole)


def record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None) -> bytes:
    """An uncompressed record. A revisit keeps the HTTP header, with the payload's length, and no payload."""
    payload = html.encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {RECORD_DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {_line(url)}")
    if refers_to is not None:
        head.insert(3, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.insert(4, f"WARC-Refers-To: {_urn(refers_to)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> dict:
    """Header fields by lower-case name, and the payload after the HTTP header."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n" or len(block) != int(fields["content-length"]):
        raise ValueError("a WARC record is cut short")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["http-length"] = next(x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    return {"fields": fields, "payload": payload}


def _member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def write_archives(rows: DataFrame, folder: str, max_bytes: int = 256_000_000) -> DataFrame:
    """Write a record per row of ``revisits`` below ``folder`` and return the stored index.

    ``folder`` is one that all executors reach. File names are unique to the task attempt that writes
    them and the index only names files of attempts that succeeded, so a lost executor leaves at most an
    unlisted file behind. A file that reaches ``max_bytes`` is closed and the next one begun.
    """
    names = [x.split()[0] for x in INDEX_SCHEMA.split(", ")]
    archives = _qualified(rows.sparkSession, f"{folder}/archives")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = _filesystem(archives)
        filesystem.create_dir(path, recursive=True)
        out, name, offset = None, "", 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")]
            index = []
            for page_id, url, html, digest, refers_to in zip(*columns):
                if out is None or offset >= max_bytes:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = filesystem.open_output_stream(f"{path}/{name}", compression=None)
                member = _member(record(page_id, url, html, digest, refers_to))
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                index.append((name, offset, len(member), url, _urn(page_id), kind, digest))
                offset += len(member)
            if index:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*index)))))
        if out is not None:
            out.close()

    rows.mapInArrow(write, INDEX_SCHEMA).write.parquet(f"{folder}/index")
    return rows.sparkSession.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def read_records(
    index: DataFrame, folder: str, payloads: bool = True, gap: int = 65_536, block_bytes: int = 8_000_000
) -> DataFrame:
    """Read the records that ``index`` selects back from the archives.

    The selection is range-partitioned and sorted by file and offset; ranges no more than ``gap`` bytes
    apart are read together, up to ``block_bytes``. The digest and size of a response are computed from
    the payload read and checked against its header and index row; those of a revisit come from its
    headers. ``payloads=False`` leaves the payload out of the result.
    """
    archives = _qualified(index.sparkSession, f"{folder}/archives")
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]

    def blocks(ranges: Iterator[tuple[str, int, int, str]]) -> Iterator[list[tuple[str, int, int, str]]]:
        run: list[tuple[str, int, int, str]] = []
        for r in ranges:
            if run and (
                r[0] != run[-1][0] or r[1] > run[-1][1] + run[-1][2] + gap or r[1] + r[2] - run[0][1] > block_bytes
            ):
                yield run
                run = []
            run.append(r)
        if run:
            yield run

    def row(name: str, offset: int, raw: bytes, digest: str) -> tuple:
        found = parsed(zlib.decompress(raw, 31))
        fields = found["fields"]
        stated = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
        size = int(fields["http-length"])
        if fields["warc-type"] == "response":
            size, seen = len(found["payload"]), hashlib.sha1(found["payload"]).hexdigest()
            if not seen == stated == digest:
                raise ValueError(f"{name}: the payload at {offset} differs from its digest")
        uri = fields.get("warc-target-uri")  # as every reader finds it
        return (
            name, offset, fields["warc-record-id"], fields["warc-type"], uri,
            fields.get("warc-refers-to"), stated, size,
            found["payload"].decode() if payloads and fields["warc-type"] == "response" else None,
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = _filesystem(archives)
        opened, source = None, None
        schema = pa.schema([(n, pa.int64() if n in ("offset", "payload_bytes") else pa.string()) for n in names])
        ranges = (r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("file", "offset", "length", "digest"))))
        for run in blocks(ranges):
            if run[0][0] != opened:
                if source is not None:
                    source.close()
                opened, source = run[0][0], filesystem.open_input_file(f"{path}/{run[0][0]}")
            start = run[0][1]
            block = source.read_at(run[-1][1] + run[-1][2] - start, start)
            rows = [row(f, o, block[o - start : o - start + n], d) for f, o, n, d in run]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
        if source is not None:
            source.close()

    ordered = index.select("file", "offset", "length", "digest").repartitionByRange("file", "offset")
    return ordered.sortWithinPartitions("file", "offset").mapInArrow(read, RECORD_SCHEMA)
