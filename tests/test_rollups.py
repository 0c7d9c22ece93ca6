"""Roll-ups answer what the lines answer, from fewer rows, and only while they are up to date."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.operators.distinct import distinct_bitmaps, distinct_counts, united
from martloom.plans import commercial
from martloom.plans.commercial import commercial_view
from martloom.plans.incremental import refresh_incrementally
from martloom.plans.refresh import stored_mart
from martloom.plans.rollups import COMMERCIAL_GRAINS, LAYER, RolledView, refresh_rollups
from martloom.plans.silver import SPECS
from martloom.sinks.lake import Lake

ALL = {m.name: m.name for m in commercial.MEASURES}


@pytest.fixture(scope="module")
def lake(spark, sample, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("rolled")))
    for table in SPECS:
        rows = sample.bronze(table)
        lake.table("bronze", table).append(rows, rows.schema, "load-0", {"loads": True})
    refresh_incrementally(lake, analytics=False)
    roll(lake)
    return lake


def roll(lake):
    mart = stored_mart(lake)
    return refresh_rollups(lake, commercial_view(mart), mart.sales_transactions)


def both(lake, measures, by=None, where=None):
    view = commercial_view(stored_mart(lake))
    rolled = RolledView(lake, view)
    rows = lambda df: Counter(tuple(sorted(r.asDict().items())) for r in df.collect())
    return rolled.route(measures, by or {}, where), rows(rolled.query(measures, by, where)), rows(view.query(measures, by, where))


@pytest.mark.parametrize("by,where,grain", [
    ({}, None, "sales_year_category_region"),
    ({"a": "Ano"}, None, "sales_year_category_region"),
    ({"t": "TipoNegocio"}, None, "sales_year_category_region"),
    ({"c": "Categoria", "r": "Regiao"}, lambda d: d("Ano") >= 1996, "sales_year_category_region"),
    ({"m": "Mes", "p": "Pais"}, lambda d: d("Regiao") == "ASIA", "sales_month_subcategory_country"),
    ({"d": "Data"}, None, "sales_day_region"),
    ({"p": "Produto"}, None, "sales_year_product"),
    ({"p": "Produto", "r": "Regiao"}, None, None),
    ({"c": "Cliente"}, None, None),
    ({"a": "Ano"}, lambda d: d("Ano") > 9999, "sales_year_category_region"),
    ({}, lambda d: d("Ano") > 9999, "sales_year_category_region"),
])
def test_every_measure_equals_the_lines(lake, by, where, grain):
    route, got, want = both(lake, ALL, by, where)
    assert (route.name if route else None) == grain
    assert got == want


def test_types_do_not_depend_on_the_route(lake):
    view = commercial_view(stored_mart(lake))
    assert RolledView(lake, view).query(ALL, {"a": "Ano"}).dtypes == view.query(ALL, {"a": "Ano"}).dtypes


def test_a_rolled_question_reads_no_lines_and_one_year(lake):
    df = RolledView(lake, commercial_view(stored_mart(lake))).query(ALL, {"t": "TipoNegocio"}, lambda d: d("Ano") == 1997)
    assert df.inputFiles() and all(f"/{LAYER}/" in f for f in df.inputFiles())
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PartitionFilters: [isnotnull(order_year" in line]
    assert len(scans) == 2 and "customer_key" not in plan.split("(1)")[-1]


def test_only_changed_years_are_made_anew_and_stale_rollups_are_not_used(spark, sample, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for table in SPECS:
        rows = sample.bronze(table)
        lake.table("bronze", table).append(rows, rows.schema, "load-0", {"loads": True})
    refresh_incrementally(lake, analytics=False)
    assert set(roll(lake).values()) == {None}
    assert set(roll(lake).values()) == {0}
    returns = sample.bronze("sales_returns")
    one = returns.filter("id % 2 = 1").orderBy(F.col("id").cast("bigint").desc()).limit(1)
    changed = one.withColumn("id", F.lit("9000000000000000000")).withColumn("unitprice", F.lit("12345,67"))
    lake.table("bronze", "sales_returns").append(changed, returns.schema, "load-1", {"loads": True})
    refresh_incrementally(lake, analytics=False)
    measures, by = {"r": "Returns", "c": "Customers Current"}, {"a": "Ano"}
    route, got, want = both(lake, measures, by)
    assert route is None and got == want  # a stale roll-up falls back to the lines
    replaced = roll(lake)
    assert set(replaced) == {g.name for g in COMMERCIAL_GRAINS} and set(replaced.values()) == {1}
    route, got, want = both(lake, measures, by)
    assert route is not None and got == want


def test_bitmaps_count_exactly_at_any_grain(spark):
    edge = [0, 1, -1, 32767, 32768, 32769, -32768, 65536, 1 << 40, -(1 << 40), (1 << 62) + 5]
    rows = [(g, h, v) for v in edge for g in "ab" for h in (1, 2) if (v + h) % 3 or g == "a"]
    rows += rows + [("a", 1, None), ("c", 1, None), (None, 3, 7)]
    df = spark.createDataFrame(rows, "g string, h int, v long")
    fine = distinct_bitmaps(df, ["g", "h"], F.col("v"))
    for by in (["g", "h"], ["g"], ["h"], []):
        got = {tuple(r[c] for c in by): r.n for r in distinct_counts(fine, by, by, "n").collect()}
        want = {}
        for r in rows:
            if r[2] is not None:
                want.setdefault(tuple(r["gh".index(c)] for c in by), set()).add(r[2])
        assert got == {k: len(v) for k, v in want.items()}
    again = united(united(fine, ["g"]), ["g"])
    assert {r.g: r.n for r in distinct_counts(again, ["g"], ["g"], "n").collect()} == {r.g: r.n for r in distinct_counts(fine, ["g"], ["g"], "n").collect()}


def test_all_rollups_of_the_same_years_are_made_of_lines_read_once(lake):
    mart, calls = stored_mart(lake), []
    grains = tuple(g for g in COMMERCIAL_GRAINS if g.name == "sales_year_category_region")
    other = Lake(lake.spark, lake.root)
    other.table = lambda layer, t: Lake.table(lake, layer, f"again_{t}" if layer == LAYER else t)
    done = refresh_rollups(
        other, commercial_view(mart), lambda: calls.append(1) or mart.sales_transactions().filter("order_year = 1996"), grains
    )
    assert done == {"sales_year_category_region": None} and len(calls) == 1


def test_no_bitmap_is_shuffled_before_its_numbers_are_together(spark):
    rows = spark.range(1000).selectExpr("id", "id % 900 AS g")
    made = distinct_bitmaps(rows, ["g"], F.col("id"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    exchange = plan[plan.index("Exchange "):]
    assert "bitmap_construct_agg" not in exchange and distinct_counts(made, [], [], "n").first()[0] == 1000


def test_lines_of_rollups_meet_the_names_of_places_last(spark, sf_dir, monkeypatch):
    """The flat view that joins places at its end is written once, as stored tables are."""
    from martloom.plans import rollups
    from martloom.registry import stored
    from martloom.registry.core import Context

    seen = []
    monkeypatch.setattr(stored, "refresh_rollups", lambda lake, view, rows: seen.append((rows, rollups._lines_at_hand(rows(), view, COMMERCIAL_GRAINS))))
    stored._rolled(Context(spark, sf_dir))
    ((rows, lines),) = seen
    assert rows.__name__ == "transactions_view" and lines.inputFiles() and all(".zstd." in f for f in lines.inputFiles())
    assert lines.count() == rows().count() > 0
