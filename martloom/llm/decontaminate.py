"""Benchmark decontamination as a prefix-filtered set join.

A document word is hit when it lies inside an occurrence of a window: 13 consecutive words of a
benchmark item, or all words of a shorter one. Occurrences are found in three steps:

1. Shingles (three consecutive words) of the windows are counted over all documents and ordered by
   rarity. A window that occurs has all its shingles in the document, so its prefix is its rarest one
   alone; a window whose rarest shingle occurs nowhere is done.
2. Document positions join the windows on that shingle. The window's place relative to it and both
   lengths bound where it can start.
3. The words from that start are compared with the whole window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.tables import LOWER, UPPER, fresh, stored

WINDOW, SHINGLE = 13, 3
#: ASCII that separates words: all but letters and digits.
_BREAKS = "".join(map(chr, (c for c in range(128) if not chr(c).isalnum())))
#: Windows are sent to the tasks whole (some 300 bytes each) while they and the items that hold them are at
#: most this many together; beyond it, joins shuffle.
BROADCAST_WINDOWS = 100_000


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words: runs of ASCII letters, digits and all non-ASCII characters."""
    plain = F.translate(F.coalesce(text.cast("string"), F.lit("")), _BREAKS + UPPER, " " * len(_BREAKS) + LOWER)
    return F.array_remove(F.split(plain, " "), "")


def _key(words: str | Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + i) for i in range(k)])


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Distinct windows: ``wid, win, size, k, items`` (the ids of the items that hold it, as text).

    Items without words have none; a null ``item_id`` reads as ``null``.
    """
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words_of(F.col("text")).alias("words")
    ).withColumn("size", F.least(F.size("words"), F.lit(WINDOW))).filter("size > 0")
    each = items.select(
        "item", "size",
        F.explode(F.transform(
            F.sequence(F.lit(0), F.size("words") - F.col("size")), lambda i: F.slice("words", i + 1, F.col("size"))
        )).alias("win"),
    )
    return each.groupBy("win", "size").agg(F.collect_set("item").alias("items")).select(
        F.xxhash64("win").alias("wid"), "win", "size", F.least("size", F.lit(SHINGLE)).alias("k"), "items"
    )


def _window_shingles(windows: DataFrame, k: int) -> DataFrame:
    """``wid, at, key``: the shingles of the windows that use shingles of ``k`` words."""
    return windows.filter(F.col("k") == k).select(
        "wid", "win", F.explode(F.sequence(F.lit(0), F.col("size") - k)).alias("at")
    ).select("wid", "at", _key("win", F.col("at"), k).alias("key"))


def _positions(docs: DataFrame, k: int, first: int) -> DataFrame:
    """A row per shingle position of a document from ``first`` on; position -1 stands for the document."""
    low = F.lit(first)
    return docs.select(
        "*", F.explode(F.sequence(low, F.greatest(low, F.col("n_words") - k), F.lit(1))).alias("pos")
    ).select(
        "*", F.when((F.col("pos") >= 0) & (F.col("pos") + k <= F.col("n_words")), _key("words", F.col("pos"), k)).alias("key")
    )


def prefixes(docs: DataFrame, windows: DataFrame, k: int, small: bool) -> DataFrame:
    """``key, wid, at``: the rarest shingle of each window that any document holds, by counts over all."""
    shingles = _window_shingles(windows, k)
    wanted = shingles.select("key").distinct()
    held = _positions(docs, k, 0).select("key").join(F.broadcast(wanted) if small else wanted, "key", "left_semi")
    counts = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    ranked = shingles.join(counts, "key", "left").groupBy("wid").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "at")).alias("rarest")
    )
    return ranked.filter("rarest.n > 0").select("wid", "rarest.key", "rarest.at")


def contamination(
    documents: DataFrame, benchmark: DataFrame, broadcast_windows: int = BROADCAST_WINDOWS
) -> DataFrame:
    """Per row of ``documents``: words, hit words, the items found, and whether it is contaminated.

    Contaminated: at least one word is hit, and at least one in twenty. Null texts have no words. Rows
    are told apart by ``doc_id`` (which may be null) and the hash of the text; rows equal in both are
    measured together and returned one by one. An empty benchmark hits nothing. Other columns of the
    inputs are not read. ``text_hash`` is returned beside the figures.

    Windows are distinct before the join, so a passage that many items share is matched once. The number
    of windows and of items that hold them decides only whether they are broadcast or joined through shuffles.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        words_of(F.col("text")).alias("words"),
    ).withColumn("n_words", F.size("words"))
    windows = benchmark_windows(benchmark)
    mentions = F.sum(F.size("items") + 1).alias("n")
    kinds = {r["k"]: r["n"] for r in windows.groupBy("k").agg(mentions).collect()}
    small = sum(kinds.values()) <= broadcast_windows
    found = []
    for k in sorted({SHINGLE, *kinds}, reverse=True):
        sentinel = k == SHINGLE  # one row per document, found in the same pass as the matches
        anchors = prefixes(docs, windows, k, small).join(windows.drop("k"), "wid")
        found.append((_matched if small else _matched_apart)(docs, anchors, k, sentinel))
    end = F.col("start") + F.col("size")
    span = F.when(F.col("start").isNotNull(), F.struct("start", end.alias("end")))
    per = reduce(DataFrame.unionByName, found).groupBy("doc_id", "text_hash").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(F.col("pos") == -1, 1)).alias("copies"),
        F.sort_array(F.collect_set(span)).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    begin = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("upto"))
    hit = F.aggregate("spans", begin, lambda a, s: F.struct(
        (a["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], a["upto"]))).alias("hit"),
        F.greatest(a["upto"], s["end"]).alias("upto"),
    ))["hit"]
    return per.select(
        "doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy").withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


_MATCH = ("doc_id", "text_hash", "n_words", "pos", "start", "size", "items")


def _verified(start: Column) -> Column:
    return (
        (start >= 0) & (start + F.col("size") <= F.col("n_words"))
        & (F.slice("words", start + 1, F.col("size")) == F.col("win"))
    )


def _matched(docs: DataFrame, anchors: DataFrame, k: int, sentinel: bool) -> DataFrame:
    """Join and comparison in the task that reads the text: nothing but matches leaves it."""
    start = F.col("pos") - F.col("at")
    joined = _positions(docs, k, -1).join(F.broadcast(anchors), "key", "left" if sentinel else "inner")
    # null-safe: the sentinel row matches nothing and stays
    holds = F.coalesce(F.when(F.col("win").isNotNull() & (start >= 0), _verified(start)), F.lit(False))
    kept = joined.filter(holds | ((F.col("pos") == -1) if sentinel else F.lit(False)))
    return kept.withColumn("start", start).select(*_MATCH)


def _matched_apart(docs: DataFrame, anchors: DataFrame, k: int, sentinel: bool) -> DataFrame:
    """The same through shuffles: candidates find the words of their document again by its keys."""
    slim = _positions(docs, k, 0).select("doc_id", "text_hash", "pos", "key").join(anchors.select("key", "wid", "at"), "key")
    candidates = slim.select(
        F.col("doc_id").alias("c_doc"), F.col("text_hash").alias("c_hash"), "pos",
        (F.col("pos") - F.col("at")).alias("start"), "wid",
    ).filter("start >= 0").distinct().join(anchors.select("wid", "win", "size", "items"), "wid")
    same = F.col("doc_id").eqNullSafe(F.col("c_doc")) & (F.col("text_hash") == F.col("c_hash"))
    texts = docs.dropDuplicates(["doc_id", "text_hash"])
    matches = texts.join(candidates, same).filter(_verified(F.col("start"))).select(*_MATCH)
    if not sentinel:
        return matches
    return docs.select(
        "doc_id", "text_hash", "n_words", F.lit(-1).alias("pos"), F.lit(None).cast("int").alias("start"),
        F.lit(None).cast("int").alias("size"), F.lit(None).cast("array<string>").alias("items"),
    ).unionByName(matches)


def uncontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents``, with all their columns, that are not contaminated."""
    h, c_doc, c_hash = fresh(documents, "h", "c_doc", "c_hash")
    # stored, so that Spark knows how few rows there are when it chooses the join
    bad = stored(contamination(documents, benchmark).filter("contaminated").select(
        F.col("doc_id").alias(c_doc), F.col("text_hash").alias(c_hash)
    ).distinct(), "contaminated")
    keyed = documents.withColumn(h, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(c_doc)) & (F.col(h) == F.col(c_hash))
    return keyed.join(bad, same, "left_anti").drop(h)


SQL = r"""
WITH d AS (
  SELECT rowid_ AS r, doc_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (
    SELECT row_number() OVER () AS rowid_, doc_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
    FROM documents)),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, w[i + 1 : i + least(len(w), 13)] AS x
  FROM (SELECT item, w, unnest(range(0, len(w) - least(len(w), 13) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT r, i, n, w[i + 1 : i + n] AS x
  FROM (SELECT r, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
m AS (SELECT dw.r, dw.i, dw.n, win.item FROM dw JOIN win ON dw.n = win.n AND dw.x = win.x),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM m) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
