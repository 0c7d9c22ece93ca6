"""Metric views: named dimensions and measures over one source, queried by name.

Base measures are ordinary aggregates and are computed once, whatever number of derived
measures use them; derived measures are column arithmetic over the aggregated row. The whole
query is one ``groupBy().agg().select()``. A view may offer reduced rows besides: figures summed over the
columns that a question reads, so that facts shrink before they meet their dimensions. They serve questions
that need neither a lookup by more columns nor a distinct count: with those kept in the keys, sums hardly
shrink the facts and cost a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Lookup = Callable[[str], Column]


@dataclass(frozen=True)
class Dimension:
    name: str
    column: str
    label: str | None = None
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class Measure:
    """``base`` aggregates source rows; ``derived`` combines measures fetched by name.

    ``distinct`` names the column of a distinct count. ``parts`` are the sums that ``base`` follows from, by name:
    they add up over any rows, so stored roll-ups hold them, and ``whole`` puts them together again.
    ``summed`` replaces ``base`` over reduced rows where the same expression would not do.
    """

    name: str
    base: Callable[[], Column] | None = None
    derived: Callable[[Lookup], Column] | None = None
    uses: tuple[str, ...] = ()
    optional_columns: tuple[str, ...] = ()
    kind: str = "currency"
    label: str | None = None
    synonyms: tuple[str, ...] = ()
    distinct: str | None = None
    parts: Mapping[str, Callable[[], Column]] | None = None
    whole: Callable[[Lookup], Column] | None = None
    summed: Callable[[], Column] | None = None

    def __post_init__(self) -> None:
        if (self.base is None) == (self.derived is None):
            raise ValueError(f"measure {self.name!r} needs exactly one of base and derived")


class MetricView:
    def __init__(
        self,
        name: str,
        source: Callable[[frozenset[str]], DataFrame],
        dimensions: Sequence[Dimension],
        measures: Sequence[Measure],
        reduced: Callable[[frozenset[str], frozenset[str]], DataFrame] | None = None,
    ) -> None:
        """``source`` receives the optional source columns the query really reads; ``reduced`` also the
        columns that its rows must keep, and is preferred where given."""
        self.name = name
        self._source = source
        self._reduced = reduced
        self.dimensions = {d.name: d for d in dimensions}
        self.measures = {m.name: m for m in measures}

    def resolve(self, term: str) -> str:
        """Dimension or measure name for a name, label or synonym, ignoring case."""
        wanted = term.strip().lower()
        members = (*self.measures.values(), *self.dimensions.values())
        for read in (
            lambda m: (m.name,),
            lambda m: (m.label,) if m.label else (),
            lambda m: m.synonyms,
        ):
            for member in members:
                if wanted in (n.lower() for n in read(member)):
                    return member.name
        raise KeyError(f"{self.name} knows nothing called {term!r}")

    def base_names(self, names: Sequence[str], path: tuple[str, ...] = ()) -> set[str]:
        found: set[str] = set()
        for name in names:
            if name in path:
                raise ValueError(f"measure cycle: {' -> '.join((*path, name))}")
            measure = self.measures[name]
            if measure.base is not None:
                found.add(name)
            else:
                found |= self.base_names(measure.uses, (*path, name))
        return found

    def value(self, name: str) -> Column:
        measure = self.measures[name]
        if measure.base is not None:
            return F.col(f"`{name}`")

        def fetch(other: str) -> Column:
            if other not in measure.uses:
                raise ValueError(f"{name!r} does not declare its use of {other!r}")
            return self.value(other)

        return measure.derived(fetch)

    def query(
        self,
        measures: Mapping[str, str],
        by: Mapping[str, str] | None = None,
        where: Callable[[Lookup], Column] | None = None,
    ) -> DataFrame:
        """``measures`` and ``by`` map an output column to a measure or dimension name."""
        by = dict(by or {})
        base = sorted(self.base_names(list(measures.values())))
        optional = frozenset(c for n in base for c in self.measures[n].optional_columns)
        asked, condition = self.asked(by, where)
        shrink = self._reduced is not None and not optional and not any(self.measures[n].distinct for n in base)
        rows = self._reduced(optional, asked) if shrink else self._source(optional)
        if condition is not None:
            rows = rows.filter(condition)
        keys = [F.col(self.dimensions[d].column).alias(out) for out, d in by.items()]

        def aggregate(measure: Measure) -> Column:
            return measure.summed() if shrink and measure.summed else measure.base()

        grouped = rows.groupBy(*keys).agg(*[aggregate(self.measures[n]).alias(n) for n in base])
        return self.presented(grouped, measures, by)

    def asked(
        self, by: Mapping[str, str], where: Callable[[Lookup], Column] | None
    ) -> tuple[frozenset[str], Column | None]:
        """The dimension columns a question reads, and its condition."""
        columns = {self.dimensions[d].column for d in by.values()}

        def column(dimension: str) -> Column:
            columns.add(self.dimensions[dimension].column)
            return F.col(self.dimensions[dimension].column)

        condition = where(column) if where is not None else None
        return frozenset(columns), condition

    def presented(self, grouped: DataFrame, measures: Mapping[str, str], by: Mapping[str, str]) -> DataFrame:
        """The asked columns from rows that have the base measures by name."""
        return grouped.select(
            *[F.col(f"`{out}`") for out in by],
            *[self.value(m).alias(out) for out, m in measures.items()],
        )

    def formatted(self, df: DataFrame, measures: Mapping[str, str]) -> DataFrame:
        """Measure columns as display text: $ with two places, % with one, plain integers."""
        shown = {}
        for out, name in measures.items():
            value = F.col(f"`{out}`").cast("double")
            kind = self.measures[name].kind
            if kind == "currency":
                text = F.concat(F.when(value < 0, "-").otherwise(""), F.lit("$"), F.format_number(F.abs(value), 2))
            elif kind == "percentage":
                text = F.concat(F.format_number(value * 100, 1), F.lit("%"))
            else:
                text = F.format_number(value, 0)
            shown[out] = text
        return df.withColumns(shown)
