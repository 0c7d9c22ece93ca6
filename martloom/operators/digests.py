"""Two tables compared by content: order-free digests over a tree of key ranges, opened only where they differ.

Each side is summed up in one scan to a few thousand digests, so tables that agree cost a scan each and send nothing
but digests, also where the sides lie in different systems. Only rows of differing ranges are read again, and
compared key by key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of a position, and of those the bits that a level of the tree opens.
BITS, STEP = 24, 12
#: So many ranges at most go to the scan as conditions on the key; for more, their outer bounds do.
CONDITIONS = 50
WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ROW, _AT = "_row", "_at"


def _row_hash(df: DataFrame, like: DataFrame) -> Column:
    """A hash of the row in the types of ``like``; the two zeros of floating point are one, as is every NaN."""

    def plain(field: T.StructField) -> Column:
        value = F.col(f"`{field.name}`").cast(field.dataType)
        return F.to_json(value) if isinstance(field.dataType, T.MapType) else value

    missing = set(like.columns) ^ set(df.columns)
    if missing:
        raise ValueError(f"only one side has {', '.join(sorted(missing))}")
    values = [F.struct(plain(f).isNull(), plain(f)) for f in sorted(like.schema.fields, key=lambda f: f.name)]
    return F.xxhash64(*values)


class _Tree:
    """How keys become positions: by value for one whole-number column, so that ranges reach the scan; else by hash."""

    def __init__(self, source: DataFrame, target: DataFrame, key: Sequence[str]) -> None:
        self.key = list(key)
        self.numeric = len(self.key) == 1 and isinstance(source.schema[self.key[0]].dataType, WHOLE)
        self.low, self.width = 0, 1
        if self.numeric:
            ends = [df.agg(F.min(self.key[0]).alias("a"), F.max(self.key[0]).alias("b")).first() for df in (source, target)]
            known = [r for r in ends if r["a"] is not None]
            if known:
                self.low = min(r["a"] for r in known)
                self.width = -(-(max(r["b"] for r in known) - self.low + 1) // (1 << BITS))

    def position(self) -> Column:
        if not self.numeric:
            return F.shiftrightunsigned(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), 64 - BITS)
        wide = F.col(f"`{self.key[0]}`").cast("decimal(20,0)") - F.lit(self.low).cast("decimal(20,0)")
        at = F.floor((wide - F.pmod(wide, F.lit(self.width).cast("decimal(20,0)"))) / F.lit(self.width).cast("decimal(20,0)"))
        return F.coalesce(at.cast("long"), F.lit(-1).cast("long"))  # rows without a key are a range of their own

    def only(self, df: DataFrame, nodes: Sequence[int], shift: int) -> DataFrame:
        """Rows of some ranges; for whole-number keys by conditions that file statistics can use."""
        if self.numeric:
            key, size = F.col(f"`{self.key[0]}`"), self.width << shift
            spans = [(self.low + n * size, self.low + (n + 1) * size - 1) for n in nodes if n >= 0]
            if len(spans) > CONDITIONS:
                spans = [(min(a for a, _ in spans), max(b for _, b in spans))]
            within = [key.between(a, b) for a, b in spans]
            if any(n < 0 for n in nodes):
                within.append(key.isNull())
            df = df.filter(reduce(Column.__or__, within))
        listed = df.sparkSession.createDataFrame([(n,) for n in nodes], "_node long")
        return df.withColumn("_node", F.shiftright(self.position(), shift)).join(F.broadcast(listed), "_node", "left_semi").drop("_node")


def _differing(source: DataFrame, target: DataFrame, tree: _Tree, shift: int) -> list[int]:
    """Ranges whose digests differ: at most as many as a level has."""

    def digests(df: DataFrame, sign: int) -> DataFrame:
        return df.groupBy(F.shiftright(_AT, shift).alias("node")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col(_ROW).cast("decimal(38,0)")).alias("total"), F.bit_xor(_ROW).alias("mix"),
        ).withColumn("sign", F.lit(sign))

    both = digests(source, 1).unionByName(digests(target, -1))
    uneven = both.groupBy("node", "n", "total", "mix").agg(F.sum("sign").alias("left")).filter("left <> 0")
    return sorted(r["node"] for r in uneven.select("node").distinct().collect())


def content_differences(source: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """``key``, ``kind``, ``source_rows``, ``target_rows`` of every key whose rows differ: ``missing`` from the
    target, ``extra`` in it, or ``changed``.

    Repeated rows count as often as they occur; NULL keys are keys. Both sides must have the same columns; target
    values are compared in the types of the source. The number of ranges that comes to the driver is
    fixed by the tree, rows never do.
    """
    names, tree = list(key), _Tree(source, target, key)

    def hashed(df: DataFrame) -> DataFrame:
        keys = [F.col(f"`{k}`").cast(source.schema[k].dataType).alias(k) for k in names]
        return df.select(*keys, _row_hash(df, source).alias(_ROW)).withColumn(_AT, tree.position())

    sides = [source, target]
    for shift in range(BITS - STEP, -1, -STEP):
        nodes = _differing(hashed(sides[0]), hashed(sides[1]), tree, shift)
        if not nodes:
            sides = [s.limit(0) for s in sides]
            break
        sides = [tree.only(s, nodes, shift) for s in (source, target)]
    rows = hashed(sides[0]).withColumn("_side", F.lit(1)).unionByName(hashed(sides[1]).withColumn("_side", F.lit(-1)))
    uneven = rows.groupBy(*names, _ROW).agg(F.sum("_side").alias("_left")).filter("_left <> 0")
    counted = uneven.groupBy(*names).agg(
        F.sum(F.greatest("_left", F.lit(0))).alias("source_rows"), F.sum(F.greatest(-F.col("_left"), F.lit(0))).alias("target_rows")
    )
    kind = F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("changed")
    return counted.select(*names, kind.alias("kind"), "source_rows", "target_rows")
