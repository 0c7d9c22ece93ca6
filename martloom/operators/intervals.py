"""Containment join of intervals with validity periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bucket(ts: Column, bucket_days: int) -> Column:
    day = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date"))
    return F.floor(day / bucket_days).cast("bigint")


def interval_join(
    facts: DataFrame,
    periods: DataFrame,
    key: str,
    left: tuple[str, str],
    right: tuple[str, str],
    bucket_days: int | None = None,
) -> DataFrame:
    """Rows whose [start, end] lies inside a period of the same key; an open period has no end.

    The key drives a hash join and the bounds are checked on it, which is all that is needed
    while the period table is small. With ``bucket_days`` the periods are laid out over time
    buckets and the bucket joins too, so a key with very many periods compares each fact only
    with the periods of its own bucket. Periods are laid out from the oldest to the newest fact only.
    """
    start, end = left
    p_start, p_end = right
    inside = (F.col(start) >= F.col(p_start)) & (
        (F.col(end) <= F.col(p_end)) | F.col(p_end).isNull()
    )
    if bucket_days is None:
        keep = [c for c in periods.columns if c != key]
        return facts.join(periods, key).filter(inside).select(*facts.columns, *keep)
    oldest, newest = facts.agg(F.min(start)).scalar(), facts.agg(F.max(start)).scalar()
    first = F.greatest(F.col(p_start), oldest)
    last = F.least(F.coalesce(F.col(p_end), newest), newest)
    laid_out = periods.filter(first <= last).withColumn(
        "_bucket", F.explode(F.sequence(_bucket(first, bucket_days), _bucket(last, bucket_days)))
    )
    keep = [c for c in periods.columns if c != key]
    return (
        facts.withColumn("_bucket", _bucket(F.col(start), bucket_days))
        .join(laid_out, [key, "_bucket"])
        .filter(inside)
        .select(*facts.columns, *keep)
    )


def _as_of(
    facts: DataFrame, periods: DataFrame, key: str, at: str, p_start: str, bucket_days: int, salts: int
) -> DataFrame:
    """Facts with ``_period``: the period of their key that began last at or before ``at`` (NULL if none did).

    One sort of facts and periods together, the last period carried forward. A key is cut into time buckets and
    these into ``salts``, so its facts are shared by many tasks; each bucket opens with the period
    that was valid before it, found among one row per key and bucket. NULL keys and times get no period.
    """
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    plain = [F.col(f"_fact.`{f.name}`") for f in facts.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
    period = F.struct(*[F.col(f"`{c}`") for c in periods.columns])
    facts = facts.select(F.col(key).alias("_key"), F.col(at).alias("_at"), fact.alias("_fact"))
    facts = facts.withColumns({
        "_bucket": _bucket(F.col("_at"), bucket_days), "_salt": F.pmod(F.xxhash64(F.lit(0), *plain), F.lit(salts)).cast("int"),
    })
    starts = periods.filter(F.col(p_start).isNotNull()).select(
        F.col(key).alias("_key"), F.col(p_start).alias("_at"), period.alias("_period")
    ).withColumn("_bucket", _bucket(F.col("_at"), bucket_days))
    # what is valid when a bucket with facts opens: over one row per key and bucket
    last = starts.groupBy("_key", "_bucket").agg(F.max_by("_period", "_at").alias("_period"))
    asked = facts.select("_key", "_bucket").distinct().withColumn("_asked", F.lit(True))
    earlier = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    opening = (
        last.join(asked, ["_key", "_bucket"], "full")
        .withColumn("_before", F.last("_period", ignorenulls=True).over(earlier))
        .filter("_asked AND _before IS NOT NULL")
        .select("_key", F.col(f"_before.{p_start}").alias("_at"), F.col("_before").alias("_period"), "_bucket")
    )
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    marks = starts.join(asked, ["_key", "_bucket"], "left_semi").unionByName(opening).select("*", every_salt)
    both = facts.unionByName(marks, allowMissingColumns=True)
    in_time = Window.partitionBy("_key", "_bucket", "_salt").orderBy(
        "_at", F.col("_fact").isNotNull()
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    valid = F.when(F.col("_at").isNotNull() & F.col("_key").isNotNull(), F.last("_period", ignorenulls=True).over(in_time))
    carried = both.withColumn("_valid", valid)
    return carried.filter("_fact IS NOT NULL").select("_fact.*", F.col("_valid").alias("_period"))


def aligned(
    facts: DataFrame,
    periods: DataFrame,
    key: str,
    left: tuple[str, str],
    right: tuple[str, str],
    prorate: str | None = None,
    bucket_days: int = 7,
    salts: int = 1,
) -> DataFrame:
    """Facts with the period that holds them, by one sort in place of a range join.

    Periods of a key must not overlap; then the result is that of ``interval_join``, but for a fact without
    duration at the instant of a change, which belongs to the later period alone. A period ends at its end
    inclusively, an open one never. With ``prorate``, a fact that reaches over a change is split at it: each
    part has the start, the end and its share by time of the ``prorate`` column (decimal of 12 places), and time
    that no period covers is left out. A fact without duration is never split. ``salts`` cuts buckets
    that hold very many facts of one key.
    """
    (start, end), (p_start, p_end) = left, right
    keep = [c for c in periods.columns if c != key]
    given = facts.columns
    found = _as_of(facts, periods, key, start, p_start, bucket_days, salts)
    until = F.col(f"_period.{p_end}")
    begun = F.col("_period").isNotNull()
    holds = F.coalesce(begun & (until.isNull() | (F.col(end) <= until)), F.lit(False))
    inside = found.filter(holds).select(*given, *[F.col(f"_period.{c}").alias(c) for c in keep])
    if prorate is None:
        return inside
    numbered = periods.withColumn("_number", F.row_number().over(Window.partitionBy(key).orderBy(p_start)))
    # only what reaches over a change looks for the period of its end as well
    over = facts.filter((F.col(start) < F.col(end))).withColumn("_whole", F.col(prorate))
    over = _as_of(over, numbered, key, start, p_start, bucket_days, salts)
    over = over.filter(~holds).withColumn("_first", F.coalesce("_period._number", F.lit(1))).drop("_period")
    over = _as_of(over, numbered, key, end, p_start, bucket_days, salts).withColumn("_last", F.col("_period._number")).drop("_period")
    split = over.filter("_last >= _first").withColumn("_number", F.explode(F.sequence("_first", "_last")))
    parts = split.join(numbered, [key, "_number"])
    low, high = F.greatest(start, p_start), F.least(end, p_end)
    length = lambda a, b: F.timestamp_diff("MICROSECOND", a, b).cast("decimal(20,0)")
    share = F.col("_whole").cast("decimal(18,6)") * length(F.col("_low"), F.col("_high")) / length(F.col(start), F.col(end))
    parts = parts.withColumns({"_low": low, "_high": high}).filter("_low < _high").withColumn(prorate, share.cast("decimal(38,12)"))
    parts = parts.withColumns({start: F.col("_low"), end: F.col("_high")})
    whole = inside.withColumn(prorate, F.col(prorate).cast("decimal(38,12)"))
    return whole.select(*given, *keep).unionByName(parts.select(*given, *keep))
