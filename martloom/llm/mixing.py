"""Mixing sources to target weights by hierarchical budgets.

The tree is domain, language, source; a leaf is one combination of the three. A token budget goes from
the root down in proportion to the weights of the children. A subtree can use no more than its tokens
times ``max_epochs``: what a child cannot use goes to its siblings, and only what a whole subtree cannot
use goes to the siblings of its parent. Each leaf then takes its budget as whole epochs plus a prefix of
one more epoch, in an order seeded per epoch. The prefix ends before the first document that would exceed
the budget, so a very long document early in the order can leave much of it unspent; what a leaf leaves
goes to no other leaf. ``leaf_shortfalls`` reports it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martloom.llm.tables import SPACES, fresh, stored

TREE = ("domain", "language", "origin")
_NONE = "(none)"


@dataclass(frozen=True)
class Mix:
    """Whole-number weights by name (1 where none is given, 0 leaves a subtree out), and the budget as a
    percentage of all tokens."""

    domains: Mapping[str, int] = field(default_factory=lambda: {"web": 5, "reference": 3, "forum": 2})
    languages: Mapping[str, int] = field(default_factory=lambda: {"en": 6, "de": 2, "fr": 2, "es": 1})
    sources: Mapping[str, int] = field(default_factory=dict)
    #: Domain by source, ``other`` for a source that is not listed; None: by the number at the end of a source.
    domain_map: Mapping[str, str] | None = None
    percent: int = 60
    max_epochs: int = 2
    seed: int = 7


def domain_of(source: Column, domain_map: Mapping[str, str] | None = None) -> Column:
    """The domain of a source by a map, or by the number at its end; other sources are ``other``."""
    if domain_map is not None:
        if not domain_map:
            return F.lit("other")
        listed = F.create_map(*[F.lit(x) for pair in sorted(domain_map.items()) for x in pair])
        return F.coalesce(F.try_element_at(listed, source), F.lit("other"))
    number = F.regexp_extract(source, r"(\d{1,9})$", 1)
    names = F.array(F.lit("web"), F.lit("reference"), F.lit("forum"))
    return F.when(number == "", "other").otherwise(F.get(names, (number.cast("int") % 3).cast("int")))


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    plain = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.size(F.array_remove(F.split(plain, " "), "")).cast("long")


def _leaf(mix: Mix) -> dict[str, Column]:
    source = F.coalesce(F.col("source").cast("string"), F.lit(_NONE))
    return {
        "domain": domain_of(source, mix.domain_map), "language": F.coalesce(F.col("lang").cast("string"), F.lit(_NONE)), "origin": source,
    }


def _identity() -> Column:
    """What seeds the order of a row: its id and its text."""
    return F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.encode(F.coalesce("text", F.lit("")), "utf-8"))
    )


def _weight(name: str, weights: Mapping[str, int]) -> Column:
    out = F.lit(1)
    for key, weight in weights.items():
        out = F.when(F.col(name) == key, weight).otherwise(out)
    return out.cast("long")


def _share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Budgets of children from ``budget`` of the parent, ``weight`` and ``cap``; whole numbers that sum up.

    Children are filled in the order of cap per weight: one whose cap is below its share of what is left
    keeps the cap, and the rest share what remains by weight.
    """
    order = Window.partitionBy(*parent).orderBy((F.col("cap").cast("double") / F.col("weight").cast("double")), name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    from_here = order.rowsBetween(0, Window.unboundedFollowing)
    whole = lambda c: c.cast("decimal(18,0)")
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    staged = children.withColumns({"left": left, "weight_left": F.sum("weight").over(from_here)}).withColumn(
        "full", whole(F.col("cap")) * whole(F.col("weight_left")) <= whole(F.col("left")) * whole(F.col("weight"))
    )
    group = Window.partitionBy(*parent)
    rest = F.when(F.col("full"), 0).otherwise(F.col("weight"))
    staged = staged.withColumns({
        "rest": F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(group),
        "rest_weight": F.sum(rest).over(group),
        "upto": F.sum(rest).over(order.rowsBetween(Window.unboundedPreceding, 0)),
    })
    staged = staged.withColumn("part", F.when(F.col("full"), F.col("cap")).otherwise(F.expr(
        "cast(cast(rest as decimal(18,0)) * cast(upto as decimal(18,0)) div cast(rest_weight as decimal(18,0)) as long)"
        " - cast(cast(rest as decimal(18,0)) * cast(upto - weight as decimal(18,0)) div cast(rest_weight as decimal(18,0)) as long)"
    )))
    return staged.select(*parent, name, F.col("part").alias("budget"))


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``domain, language, origin, tokens, budget`` from the token sums of the leaves."""
    weighted = leaves.withColumns({
        "w1": _weight("domain", mix.domains), "w2": _weight("language", mix.languages), "w3": _weight("origin", mix.sources),
        "cap": F.col("tokens") * mix.max_epochs,
    }).withColumn("cap", F.when((F.col("w1") > 0) & (F.col("w2") > 0) & (F.col("w3") > 0), F.col("cap")).otherwise(0))
    usable = weighted.filter("w1 > 0 and w2 > 0 and w3 > 0")
    whole = weighted.agg(F.least(F.expr(f"sum(tokens) * {int(mix.percent)} div 100"), F.sum("cap")).alias("budget"))
    budgets, parent = None, []
    for name, w in zip(TREE, ("w1", "w2", "w3")):
        children = usable.groupBy(*parent, name).agg(F.max(w).alias("weight"), F.sum("cap").alias("cap"))
        above = children.join(budgets, parent) if parent else children.withColumn("budget", whole.scalar())
        budgets = _share(above, parent, name)
        parent = [*parent, name]
    return leaves.join(budgets, list(TREE), "left").withColumn("budget", F.coalesce("budget", F.lit(0)))


def _order_key(epoch: Column, identity: Column, seed: int) -> Column:
    return F.md5(F.encode(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), identity), "utf-8"))


def mix_plan(documents: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """The stored word counts (a row per document) and the plan (a row per leaf: whole epochs, and the
    last order key of the prefix).

    The prefix is the longest whose tokens fit; rows with equal keys (the same id and text) go together.
    It is found digit by digit: token sums per leaf and first digits of the key are summed up in order,
    then those within the slice in which the prefix ends, and at last the rows of one slice in 65,536.
    No task sees a whole leaf, however large. Both results are stored.
    """
    counts = stored(
        documents.select("doc_id", word_count(F.col("text").cast("string")).alias("tokens"), _identity().alias("identity"),
                         *[c.alias(n) for n, c in _leaf(mix).items()]),
        "mixing-counts",
    )
    leaves = counts.groupBy(*TREE).agg(F.sum("tokens").alias("tokens"))
    used = F.expr("case when tokens > 0 then budget div tokens else 0 end")
    plan = stored(
        leaf_budgets(leaves, mix).withColumn("epochs", used).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")),
        "mixing-plan",
    )
    tree = list(TREE)
    inside = counts.join(plan.filter("rest > 0").select(*TREE, "epochs", "rest"), tree).withColumn(
        "key", _order_key(F.col("epochs"), F.col("identity"), mix.seed)
    ).withColumn("before", F.lit(0).cast("long"))
    cutoff = plan.select(*TREE)
    for digits in (2, 4):
        sliced = inside.withColumn("slice", F.substring("key", 1, digits))
        sums = sliced.groupBy(*TREE, "slice").agg(
            F.sum("tokens").alias("sum"), F.max("rest").alias("rest"), F.max("before").alias("before"), F.max("key").alias("last")
        )
        running = F.sum("sum").over(Window.partitionBy(*TREE).orderBy("slice"))
        sums = sums.withColumn("through", F.col("before") + running)
        fits = F.col("through") <= F.col("rest")
        cut = stored(sums.groupBy(*TREE).agg(
            F.max(F.when(fits, F.col("last"))).alias(f"cut{digits}"),
            F.min(F.when(~fits, F.struct("slice", (F.col("through") - F.col("sum")).alias("before")))).alias("end"),
        ), f"mixing-cut{digits}")
        cutoff = cutoff.join(cut.select(*TREE, f"cut{digits}"), tree, "left")
        end = cut.select(*TREE, F.col("end.slice").alias("slice"), F.col("end.before").alias("before"))
        inside = sliced.drop("before").join(end, [*TREE, "slice"]).drop("slice")
    running = F.sum("tokens").over(Window.partitionBy(*TREE).orderBy("key").rangeBetween(Window.unboundedPreceding, 0))
    ends = inside.withColumn("through", F.col("before") + running).filter("through <= rest").groupBy(*TREE).agg(
        F.max("key").alias("cut32")
    )
    cutoff = cutoff.join(ends, tree, "left").select(*TREE, F.greatest("cut2", "cut4", "cut32").alias("cutoff"))
    # stored, so that Spark knows how small the plan is when it meets the texts
    return counts, stored(
        plan.join(cutoff, tree, "left").select(*TREE, F.col("tokens").alias("leaf_tokens"), "budget", "epochs", "cutoff"), "mixing-leaves"
    )


def _copies(seed: int) -> Column:
    inside = _order_key(F.col("epochs"), F.col("identity"), seed) <= F.col("cutoff")
    return (F.col("epochs") + F.when(inside, 1).otherwise(0)).cast("long")


def mixed_counts(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row of ``documents``: leaf, tokens, the leaf's budget, and ``copies``, how often it is selected.

    Null and empty texts have no tokens and go with the prefix they sort into; a null language or source
    is a name of its own, ``(none)``. Repeated rows are selected together. Other columns are not read.
    """
    counts, plan = mix_plan(documents, mix)
    return counts.join(plan, list(TREE)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "domain", F.col("language").alias("lang"),
        F.col("origin").alias("source"), "tokens", "budget", _copies(mix.seed).alias("copies"),
    )


def leaf_shortfalls(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per leaf: its ``documents``, ``budget``, the tokens ``used``, and ``shortfall``, the budget left unspent."""
    used = F.sum(F.col("tokens") * F.col("copies"))
    return mixed_counts(documents, mix).groupBy("domain", "lang", "source").agg(
        F.count(F.lit(1)).alias("documents"), F.max("budget").alias("budget"), used.alias("used")
    ).withColumn("shortfall", F.col("budget") - F.col("used"))


def mixed(documents: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The selected rows with all their columns, each as often as it is selected."""
    _, plan = mix_plan(documents, mix)
    names = dict(zip((*TREE, "identity"), fresh(documents, *TREE, "identity")))
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                              *[c.alias(n) for n, c in _leaf(mix).items()], _identity().alias("identity"))
    chosen = packed.join(plan.select(*TREE, "epochs", "cutoff"), list(TREE)).withColumn("copies", _copies(mix.seed))
    return chosen.filter("copies > 0").withColumn(
        "copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    ).select("row.*")


def mix_sql(mix: Mix = Mix()) -> str:
    """The same in DuckDB SQL, leaf by leaf with running sums over whole leaves."""

    def case(name: str, weights: Mapping[str, int]) -> str:
        whens = " ".join(f"WHEN {name} = '{k}' THEN {v}" for k, v in weights.items())
        return f"(CASE {whens} ELSE 1 END)" if whens else "1"

    def level(n: int, parents: list[str], name: str, weight: str, above: str) -> str:
        keys = ", ".join([*parents, name])
        up = ", ".join(parents)
        part = f"PARTITION BY {up}" if up else ""
        source = f"JOIN {above} USING ({up})" if up else f"CROSS JOIN {above}"
        head = f"{up}, " if up else ""
        return f"""
c{n} AS (SELECT {keys}, max({weight}) AS weight, sum(cap) AS cap FROM usable GROUP BY {keys}),
o{n} AS (SELECT c.*, budget, budget - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wl,
         row_number() OVER w AS pos
  FROM c{n} c {source} WINDOW w AS ({part} ORDER BY cap::DOUBLE / weight::DOUBLE, {name})),
f{n} AS (SELECT *, cap::HUGEINT * wl <= lft::HUGEINT * weight AS full_ FROM o{n}),
s{n} AS (SELECT *, budget - sum(CASE WHEN full_ THEN cap ELSE 0 END) OVER ({part}) AS rest,
         sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER ({part}) AS rw,
         sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER ({part} ORDER BY pos) AS upto FROM f{n}),
b{n} AS (SELECT {head}{name}, CASE WHEN full_ THEN cap
         ELSE rest::HUGEINT * upto // rw - rest::HUGEINT * (upto - weight) // rw END AS budget FROM s{n})"""

    return rf"""
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens,
         coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, '')) AS identity,
         coalesce(lang, '{_NONE}') AS language, coalesce(source, '{_NONE}') AS origin,
         regexp_extract(coalesce(source, '{_NONE}'), '([0-9]{{1,9}})$', 1) AS num FROM documents),
t AS (SELECT *, CASE WHEN num = '' THEN 'other' WHEN CAST(num AS INTEGER) % 3 = 0 THEN 'web'
        WHEN CAST(num AS INTEGER) % 3 = 1 THEN 'reference' ELSE 'forum' END AS domain
      FROM (SELECT doc_id, tokens, identity, language, origin, num FROM d)),
leaves AS (SELECT domain, language, origin, sum(tokens) AS tokens FROM t GROUP BY ALL),
usable AS (SELECT *, tokens * {mix.max_epochs} AS cap, {case("domain", mix.domains)} AS w1,
             {case("language", mix.languages)} AS w2, {case("origin", mix.sources)} AS w3
           FROM leaves WHERE {case("domain", mix.domains)} > 0 AND {case("language", mix.languages)} > 0
             AND {case("origin", mix.sources)} > 0),
root AS (SELECT least((SELECT sum(tokens)::HUGEINT * {mix.percent} // 100 FROM leaves), sum(cap)) AS budget FROM usable),
{level(1, [], "domain", "w1", "root")},{level(2, ["domain"], "language", "w2", "b1")},{level(3, ["domain", "language"], "origin", "w3", "b2")},
plan AS (SELECT domain, language, origin, tokens AS leaf, coalesce(budget, 0) AS budget,
           CASE WHEN tokens > 0 THEN coalesce(budget, 0) // tokens ELSE 0 END AS epochs
         FROM leaves LEFT JOIN b3 USING (domain, language, origin)),
k AS (SELECT t.*, budget, epochs, budget - epochs * leaf AS rest, md5('{mix.seed}:' || epochs || ':' || identity) AS key
      FROM t JOIN plan USING (domain, language, origin)),
r AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, language, origin ORDER BY key
                                  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM k)
SELECT doc_id, domain, language AS lang, origin AS source, CAST(tokens AS BIGINT) AS tokens,
       CAST(budget AS BIGINT) AS budget, CAST(epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM r
"""
