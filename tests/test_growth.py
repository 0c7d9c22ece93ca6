from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from martloom.plans import forecast, growth

SALES = "product_key long, order_date date, order_quantity int, gross_sales decimal(18,4)"


def _month(y, m):
    return date(y, m, 15)


def _drivers(spark, rows, products=((1, "A"), (2, "B"), (3, None))):
    sales = spark.createDataFrame([(p, d, q, Decimal(g)) for p, d, q, g in rows], SALES)
    product = spark.createDataFrame(list(products), "product_key long, subcategory_name string")
    out = growth.price_volume_mix(sales, product).collect()
    return {(r.comparison_type, r.year_month, r.subcategory): r for r in out}


def _brute_force(rows, names):
    """The formulas evaluated month by month in plain Python."""
    months: dict = {}
    for p, d, q, g in rows:
        cell = months.setdefault((d.year * 12 + d.month - 1), {}).setdefault(names[p] or "Sem subcategoria", [0, 0.0])
        cell[0] += q
        cell[1] += float(g)
    out = {}
    for cur in months:
        for kind, back in (("MoM", 1), ("YoY", 12)):
            if cur - back not in months:
                continue
            now, base = months[cur], months[cur - back]
            q1t, q0t = sum(v[0] for v in now.values()), sum(v[0] for v in base.values())
            r0t = sum(v[1] for v in base.values())
            for s in set(now) | set(base):
                (q1, r1), (q0, r0) = now.get(s, (0, 0.0)), base.get(s, (0, 0.0))
                vol = (q1t - q0t) * (q0 / q0t) * (r0t / q0t) if q0t else 0.0
                price = q1 * (r1 / q1 - r0 / q0) if q0 and q1 else 0.0
                out[kind, cur // 12 * 100 + cur % 12 + 1, s] = (r1 - r0, vol, price, r1 - r0 - vol - price)
    return out


ROWS = [
    (1, _month(2023, 12), 4, 40), (1, _month(2024, 1), 5, 60), (2, _month(2024, 1), 3, 90),  # B is new
    (2, _month(2024, 2), 2, 50), (3, _month(2024, 2), 1, 5),  # A is gone, no subcategory appears
    (1, _month(2024, 4), 0, 7),  # March missing, zero quantity in April
    (1, _month(2024, 5), 2, 30), (1, _month(2025, 1), 6, 60),
]


def test_pvm_against_brute_force(spark):
    got = _drivers(spark, ROWS)
    want = _brute_force(ROWS, {1: "A", 2: "B", 3: None})
    assert set(got) == set(want)
    for key, effects in want.items():
        r = got[key]
        assert (r.delta_revenue, r.effect_volume, r.effect_price, r.effect_mix) == pytest.approx(effects), key


def test_new_and_removed_subcategories_land_in_mix(spark):
    got = _drivers(spark, ROWS)
    new, gone = got["MoM", 202401, "B"], got["MoM", 202402, "A"]
    assert new.effect_price == 0 and new.effect_volume == 0 and new.effect_mix == new.delta_revenue == 90
    assert gone.effect_price == 0 and gone.delta_revenue == -60


def test_months_without_a_base_are_absent(spark):
    got = _drivers(spark, ROWS)
    assert {k[1] for k in got if k[0] == "MoM"} == {202401, 202402, 202405}
    assert {k[1] for k in got if k[0] == "YoY"} == {202501}


def test_zero_quantity_base_month(spark):
    """May follows a month that sold nothing but still has revenue: no volume, no price effect."""
    r = _drivers(spark, ROWS)["MoM", 202405, "A"]
    assert (r.effect_volume, r.effect_price, r.effect_mix) == (0, 0, 23)


def test_closure(spark):
    sales = spark.createDataFrame([(p, d, q, Decimal(g)) for p, d, q, g in ROWS], SALES)
    product = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "product_key long, subcategory_name string")
    drivers = growth.price_volume_mix(sales, product)
    assert growth.pvm_closure(drivers).count() == 0
    broken = drivers.withColumn("effect_mix", drivers.effect_mix + 1)
    assert growth.pvm_closure(broken).count() > 0


def test_served_pvm_orders_by_size_and_falls_back_to_yoy(spark):
    sales = spark.createDataFrame([(p, d, q, Decimal(g)) for p, d, q, g in ROWS], SALES)
    product = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "product_key long, subcategory_name string")
    drivers = growth.price_volume_mix(sales, product)
    mom = growth.served_pvm(drivers, "MoM", 202402).collect()
    assert [r.subcategory for r in mom] == ["A", "B", "Sem subcategoria"]
    assert {r.year_month for r in growth.served_pvm(drivers, "anything").collect()} == {202501}


def test_lag_counts_rows_not_months(spark):
    sales = spark.createDataFrame(
        [(1, _month(2024, 1), 1, Decimal(10)), (1, _month(2024, 3), 1, Decimal(40)), (1, None, 1, Decimal(99))], SALES
    )
    calendar = spark.createDataFrame(
        [(_month(2024, m), 2024, m) for m in range(1, 13)], "full_date date, year int, month int"
    )
    rows = growth.time_intelligence(sales, calendar).orderBy("year_month").collect()
    assert [(r.year_month, r.gross_sales_prev_month, r.mom_pct) for r in rows] == [
        (202401, None, None), (202403, Decimal(10), 0.75),
    ]


def test_growth_of_a_zero_month_is_null(spark):
    sales = spark.createDataFrame([(1, _month(2024, 1), 1, Decimal(10)), (1, _month(2024, 2), 1, Decimal(0))], SALES)
    calendar = spark.createDataFrame([(_month(2024, m), 2024, m) for m in (1, 2)], "full_date date, year int, month int")
    assert growth.time_intelligence(sales, calendar).orderBy("year_month").collect()[1].mom_pct is None


def _history(spark, values, start=(2020, 1)):
    rows = [
        ("s", date(start[0] + (start[1] - 1 + i) // 12, (start[1] - 1 + i) % 12 + 1, 1), float(v))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "k string, ds date, y double")


def test_forecast_continues_a_line(spark):
    out = forecast.forecast(_history(spark, range(100, 148)), "k", horizon=3).orderBy("ds").collect()
    assert len(out) == 51
    assert [r.forecast for r in out[-3:]] == pytest.approx([148, 149, 150])
    assert [r.ds for r in out[-3:]] == [date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1)]
    assert all(r.forecast_lower <= r.forecast <= r.forecast_upper for r in out)
    assert all((r.y is None) == (r.ds >= date(2024, 1, 1)) for r in out)


def test_forecast_repeats_a_season(spark):
    season = [0.5, 1.5] * 6
    out = forecast.forecast(_history(spark, [100 * season[i % 12] for i in range(48)]), "k", horizon=12)
    future = [r.forecast for r in out.filter("y IS NULL").orderBy("ds").collect()]
    assert all(abs(got - 100 * want) < 8 for got, want in zip(future, season, strict=True))
    assert forecast.in_sample_mae(out, "k").first().mae < 8


@pytest.mark.parametrize("values", [[42], [42, 42], [0, 0, 0]])
def test_forecast_of_a_short_or_empty_series_is_flat(spark, values):
    out = forecast.forecast(_history(spark, values), "k", horizon=2).filter("y IS NULL").collect()
    assert [r.forecast for r in out] == pytest.approx([values[0]] * 2)


def test_series_are_independent(spark):
    both = _history(spark, range(10, 34)).unionByName(
        _history(spark, range(1000, 1024)).selectExpr("'t' AS k", "ds", "y")
    )
    alone = forecast.forecast(_history(spark, range(10, 34)), "k", horizon=5)
    joint = forecast.forecast(both, "k", horizon=5).filter("k = 's'")
    assert [r.forecast for r in joint.orderBy("ds").collect()] == pytest.approx(
        [r.forecast for r in alone.orderBy("ds").collect()]
    )
