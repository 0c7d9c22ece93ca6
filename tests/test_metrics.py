from __future__ import annotations

from decimal import Decimal

import pytest

from martloom.plans import commercial, finance
from martloom.plans.metrics import Measure, MetricView


def _commercial(spark):
    rows = spark.createDataFrame(
        [
            ("sale", 1, "N", Decimal(100), Decimal(10), 2, Decimal(50), Decimal(20)),
            ("sale", 2, "N", Decimal(50), Decimal(0), 1, Decimal(50), None),
            ("sale", 1, "S", Decimal(0), None, 0, Decimal(5), Decimal(1)),
            ("return", 1, "N", Decimal(30), Decimal(0), 1, Decimal(30), None),
            ("return", 3, "W", Decimal(5), Decimal(0), 1, Decimal(5), None),
        ],
        "transaction_type string, customer_key long, region_name string, gross_amount decimal(18,4),"
        " discount_amount decimal(18,4), quantity int, unit_price decimal(18,4), unit_cost decimal(18,4)",
    )
    asked = []

    def source(optional):
        asked.append(optional)
        return rows

    return MetricView("c", source, commercial.DIMENSIONS, commercial.MEASURES), asked


def _by_region(view, **measures):
    return {r.r: r for r in view.query(measures, {"r": "Regiao"}).collect()}


def test_every_commercial_measure(spark):
    view, _ = _commercial(spark)
    names = {f"m{i}": m.name for i, m in enumerate(commercial.MEASURES)}
    row = view.query(names, {"r": "Regiao"}).filter("r = 'N'").first()
    got = {name: getattr(row, alias) for alias, name in names.items()}
    assert got["Gross Sales"] == 150 and got["Returns"] == 30 and got["Discounts"] == 10
    assert got["Cost of Sales"] == 40 and got["Quantity"] == 3 and got["Customers Current"] == 2
    assert got["Net Sales"] == 110 and got["Gross Margin"] == 70
    assert got["Gross Margin %"] == pytest.approx(110 / 150)
    assert got["Net Margin %"] == pytest.approx(70 / 110)
    assert got["% Returns"] == pytest.approx(0.2)
    assert got["Avg Unit Price"] == 50 and got["Avg Unit Cost"] == 20
    assert len(names) == 13


def test_missing_parts_count_as_zero_and_ratios_are_null(spark):
    view, _ = _commercial(spark)
    rows = _by_region(view, net="Net Sales", returns="Returns", rate="% Returns", gm="Gross Margin %", gross="Gross Sales")
    assert rows["S"].returns is None and rows["S"].net == 0 and rows["S"].rate is None and rows["S"].gm is None
    assert rows["W"].gross is None and rows["W"].net == -5 and rows["W"].rate is None


def test_distinct_customers_are_counted_at_the_query_grain(spark):
    view, _ = _commercial(spark)
    assert view.query({"c": "Customers Current"}).first().c == 2
    assert {k: r.c for k, r in _by_region(view, c="Customers Current").items()} == {"N": 2, "S": 1, "W": 0}


def test_cost_is_read_only_when_needed(spark):
    view, asked = _commercial(spark)
    view.query({"n": "Net Sales"})
    view.query({"n": "Gross Margin"})
    assert asked == [frozenset(), frozenset({"unit_cost"})]


def test_filter_on_a_dimension(spark):
    view, _ = _commercial(spark)
    assert view.query({"n": "Net Sales"}, where=lambda d: d("Regiao") == "N").first().n == 110


@pytest.mark.parametrize(
    ("term", "name"),
    [("cogs", "Cost of Sales"), ("Vendas Líquidas", "Net Sales"), ("return rate", "% Returns"), ("segmento", "TipoNegocio"), ("Região", "Regiao")],
)
def test_synonyms(spark, term, name):
    view, _ = _commercial(spark)
    assert view.resolve(term) == name
    with pytest.raises(KeyError):
        view.resolve("unheard of")


def test_format(spark):
    view, _ = _commercial(spark)
    measures = {"n": "Net Sales", "p": "% Returns", "q": "Quantity"}
    row = view.formatted(view.query(measures, {"r": "Regiao"}), measures).filter("r = 'W'").first()
    assert (row.n, row.p, row.q) == ("-$5.00", None, None)
    row = view.formatted(view.query(measures, {"r": "Regiao"}), measures).filter("r = 'N'").first()
    assert (row.n, row.p, row.q) == ("$110.00", "20.0%", "3")


def test_measure_declarations():
    with pytest.raises(ValueError, match="exactly one"):
        Measure("x")
    loop = MetricView(
        "v", lambda _: None, (),
        (Measure("a", derived=lambda m: m("b"), uses=("b",)), Measure("b", derived=lambda m: m("a"), uses=("a",))),
    )
    with pytest.raises(ValueError, match="cycle"):
        loop.query({"a": "a"})


def test_one_sided_accounts(spark):
    rows = spark.createDataFrame(
        [("actual", "A", 3, Decimal(10)), ("budget", "B", 4, Decimal(-4)), ("actual", "C", 3, Decimal(6)), ("budget", "C", 3, Decimal(0))],
        "scenario string, account_name string, account_header_key long, signed_amount decimal(18,4)",
    )
    view = MetricView("f", lambda _: rows, finance.DIMENSIONS, finance.MEASURES)
    got = {r.c: (r.d, r.p) for r in view.query({"d": "Budget Deviation", "p": "Budget Deviation %"}, {"c": "Conta"}).collect()}
    assert got == {"A": (10, None), "B": (4, 1.0), "C": (6, None)}


def test_vertical_base_ignores_the_group(spark):
    rows = spark.createDataFrame(
        [("actual", "A", 3, Decimal(10)), ("actual", "B", 4, Decimal(-5)), ("actual", "C", 3, Decimal(30)), ("budget", "C", 3, Decimal(99))],
        "scenario string, account_name string, account_header_key long, signed_amount decimal(18,4)",
    )
    got = {r.account_name: r.va_pct for r in finance.vertical_analysis(rows, "account_name").collect()}
    assert got == {"A": 0.25, "B": -0.125, "C": 0.75}
    none = finance.vertical_analysis(rows.filter("account_name = 'B'"), "account_name").first()
    assert none.va_pct is None
