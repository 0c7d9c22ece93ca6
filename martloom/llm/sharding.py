"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Rows fall into blocks by a hash; blocks are counted.
2. One row draws the matrix: how many rows of each block go to each shard. Given the block sizes and the
   shard sizes it follows the multivariate hypergeometric law, so it is what a uniform shuffle would give.
3. Each block is permuted locally; the matrix cuts its order into runs, one per shard.
4. After the exchange each shard is permuted again, which gives the slots.

Everything is DataFrame expressions. The matrix is drawn shard by shard within a block, each count by
rejection from a log-concave law (a published universal method: a flat centre with exponential tails).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.tables import fresh, stored, text_or_empty, unit

BLOCKS = 64
SUB_BUCKETS = 1024
SEED = 20240
_TRIES = 200


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _log_factorial(n: Column) -> Column:
    """Stirling's series for ln n!, shifted by eight so that small numbers are exact to about 1e-10."""

    def series(z: Column) -> Column:
        w = z + 8.0
        rising = z
        for i in range(1, 8):
            rising = rising * (z + float(i))
        tail = 1.0 / (12.0 * w) - 1.0 / (360.0 * w * w * w) + 1.0 / (1260.0 * w * w * w * w * w)
        return (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + tail - F.log(rising)

    return _let(n.cast("double") + 1.0, series)


def hypergeometric(population: Column, good: Column, draws: Column, *key: Column) -> Column:
    """A draw of how many of ``draws`` rows are among the ``good`` ones of the population, fixed by ``key``."""
    low = F.greatest(F.lit(0).cast("long"), draws - (population - good))
    high = F.least(draws, good)

    def logp(k: Column) -> Column:
        return -(
            _log_factorial(k) + _log_factorial(good - k) + _log_factorial(draws - k)
            + _log_factorial(population - good - draws + k)
        )

    mode = F.least(high, F.greatest(low, F.floor((draws + 1) * (good + 1) / (population + 2)).cast("long")))
    scale = (
        _log_factorial(good) + _log_factorial(population - good) + _log_factorial(draws)
        + _log_factorial(population - draws) - _log_factorial(population)
    )

    def sampled(m: Column, top: Column, p: Column) -> Column:
        w = 1.0 + p / 2.0

        def attempt(t: Column) -> Column:
            u = [unit(*key, t, F.lit(i)) for i in range(4)]
            y = F.when(u[0] <= w / (1.0 + w), u[1] * w / p).otherwise((w - F.log(u[1])) / p)
            step = F.round(y).cast("long") * F.when(u[2] < 0.5, -1).otherwise(1)

            def accepted(pair: Column) -> Column:
                k, dist = m + pair["step"], pair["y"]
                inside = (k >= low) & (k <= high)
                hat = F.least(F.lit(1.0), F.exp(w - p * dist))
                return F.when(inside, F.when(u[3] * hat <= F.exp(logp(k) - top), k))

            return _let(F.struct(step.alias("step"), y.alias("y")), accepted)

        tries = F.sequence(F.lit(1), F.lit(_TRIES))
        found = F.aggregate(
            tries, F.lit(None).cast("long"), lambda a, t: F.when(a.isNotNull(), a).otherwise(attempt(t))
        )
        return F.coalesce(found, F.raise_error(F.lit(f"no draw was accepted in {_TRIES} tries")).cast("long"))

    drawn = _let(mode, lambda m: _let(logp(m), lambda top: _let(F.exp(scale + top), lambda p: sampled(m, top, p))))
    return F.when(low == high, low).otherwise(drawn)


def communication_matrix(blocks: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``block, upto``: per block the running row counts over the shards, from ``block, n``.

    One row holds all blocks while the matrix is drawn: the caller's blocks are a fixed number.
    Shard sizes differ by one at most, the larger ones first.
    """
    one = blocks.agg(F.sort_array(F.collect_list(F.struct("block", "n"))).alias("blocks"), F.sum("n").alias("total"))
    ids = F.sequence(F.lit(0), F.lit(shards - 1))
    size = lambda j: F.floor(F.col("total") / shards).cast("long") + (j < F.col("total") % shards).cast("long")

    def deal(state: Column, block: Column) -> Column:
        left = state["left"]
        start = F.struct(
            block["n"].alias("draws"),
            F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x).alias("population"),
            F.lit([]).cast("array<bigint>").alias("taken"),
        )

        def take(acc: Column, j: Column) -> Column:
            good = F.get(left, j)
            k = hypergeometric(acc["population"], good, acc["draws"], F.lit(seed), block["block"], j)
            return _let(k, lambda drawn: F.struct(
                (acc["draws"] - drawn).alias("draws"), (acc["population"] - good).alias("population"),
                F.concat(acc["taken"], F.array(drawn)).alias("taken"),
            ))

        return _let(F.aggregate(ids, start, take)["taken"], lambda taken: F.struct(
            F.zip_with(left, taken, lambda a, b: a - b).alias("left"), F.concat(state["rows"], F.array(taken)).alias("rows")
        ))

    begin = F.struct(
        F.transform(ids, size).alias("left"), F.lit([]).cast("array<array<bigint>>").alias("rows")
    )
    rows = F.aggregate("blocks", begin, deal)["rows"]
    pairs = one.select(F.explode(F.arrays_zip(F.col("blocks").alias("b"), rows.alias("counts"))).alias("x"))
    upto = F.aggregate(
        "counts", F.lit([]).cast("array<bigint>"),
        lambda a, x: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + x)),
    )
    return pairs.select(F.col("x.b.block").alias("block"), F.col("x.counts").alias("counts")).select(
        "block", upto.alias("upto")
    )


def _ranked(df: DataFrame, group: str, key: Column, tie: str, rank: str) -> DataFrame:
    """``rank`` from 0 within a group in the order of a uniform hash, without a task per group.

    Rows are ranked within ``SUB_BUCKETS`` slices of the hash; the counts of the slices before are added.
    The counts are at most groups times slices rows, a fixed number, so they are broadcast.
    """
    sub, order, n, before = fresh(df, "sub", "order", "n", "before")
    keyed = df.withColumns({sub: F.pmod(F.shiftright(key, 20), F.lit(SUB_BUCKETS)), order: key})
    counts = keyed.groupBy(F.col(group), F.col(sub)).agg(F.count(F.lit(1)).alias(n))
    ahead = Window.partitionBy(group).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, sub, F.coalesce(F.sum(n).over(ahead), F.lit(0)).alias(before))
    within = F.row_number().over(Window.partitionBy(group, sub).orderBy(order, tie))
    return (
        keyed.withColumn(rank, within)
        .join(F.broadcast(counts), [group, sub])
        .withColumn(rank, (F.col(rank) - 1 + F.col(before)).cast("long"))
        .drop(sub, order, before)
    )


def shard_rows(df: DataFrame, shards: int = 40, seed: int = SEED) -> DataFrame:
    """All rows with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 within the shard).

    Shard sizes are at most one apart. The result depends on the rows and the seed only, not on how the
    input is partitioned, so a task that runs again gives the same rows. Nulls are hashed like values.
    Rows equal in every column are interchangeable: each gets a slot of its own. An empty table gives no
    rows. Columns of the input called ``shard`` or ``slot`` are replaced; other names cannot clash.
    """
    kept = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    columns = [F.col(f"`{c}`") for c in kept]
    packed = df.select(F.struct(*columns).alias("row"), F.xxhash64(*columns).alias("h"))
    place = F.xxhash64("h", F.lit(seed))
    blocked = packed.withColumn("block", F.pmod(place, F.lit(BLOCKS)))
    counts = blocked.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    matrix = stored(communication_matrix(counts, shards, seed), "shard-matrix")
    permuted = _ranked(blocked, "block", F.xxhash64("h", F.lit(seed + 1)), "h", "rank")
    dealt = permuted.join(F.broadcast(matrix), "block").select(
        "row", "h", F.size(F.filter("upto", lambda x: x <= F.col("rank"))).alias("shard")
    )
    return _ranked(dealt, "shard", F.xxhash64("h", F.lit(seed + 2)), "h", "slot").select("row.*", "shard", "slot")


def sharded_documents(documents: DataFrame, shards: int = 40) -> DataFrame:
    """The shard and slot of every document by the ``rows`` law, with the size and checksum of its text."""
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text_or_empty()) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text_or_empty(), "utf-8")).alias("text_crc32"),
    )
    return shard_rows(rows, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
