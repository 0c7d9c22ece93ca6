from __future__ import annotations

from datetime import date
from decimal import Decimal
from itertools import product

from pyspark.sql import functions as F

from martloom.plans import rfm


def _expected(r: int, fm: float) -> str:
    """The segment table written out by recency score."""
    if r == 5:
        return "Champions" if fm > 4 else "Loyal Customers" if fm > 3 else "Potential Loyalist"
    if r == 4:
        return "Loyal Customers" if fm > 3 else "Potential Loyalist"
    if r == 3:
        return "Loyal Customers" if fm > 3 else "Needing Attention" if fm >= 2 else "About to Sleep" if fm > 1 else "Promising"
    if fm > 4:
        return "At Risk"
    if fm > 2:
        return "Lost"
    return "About to Sleep" if r == 2 else "Hibernating"


def test_all_score_triples(spark):
    triples = list(product(range(1, 6), repeat=3))
    df = spark.createDataFrame(triples, "r int, f int, m int").withColumn("fm", (F.col("f") + F.col("m")) / 2.0)
    got = {(x.r, x.f, x.m): x.segment for x in df.withColumn("segment", rfm.segment()).collect()}
    assert got == {(r, f, m): _expected(r, (f + m) / 2) for r, f, m in triples}
    assert len(set(got.values())) == 9


SALES = "customer_key long, order_date date, sales_order_number string, gross_sales decimal(18,4)"


def test_window_and_scores(spark):
    sales = spark.createDataFrame(
        [
            (1, date(2024, 12, 31), "a", Decimal(300000)),
            (1, date(2024, 12, 31), "a", Decimal(1)),
            (2, date(2023, 12, 31), "b", Decimal(10)),  # exactly twelve months back: inside
            (3, date(2023, 12, 30), "c", Decimal(10)),  # outside
            (4, date(2024, 10, 2), "d", Decimal(9999)),  # 90 days
            (4, date(2024, 10, 1), "e", Decimal(1)),
            (None, date(2024, 12, 31), "f", Decimal(1)),
        ],
        SALES,
    )
    rows = {r.customer_key: r for r in rfm.customer_rfm(sales).collect()}
    assert set(rows) == {1, 2, 4, None}
    assert (rows[1].recency_days, rows[1].sales_orders_12m, rows[1].r, rows[1].f, rows[1].m) == (0, 1, 5, 1, 5)
    assert (rows[2].recency_days, rows[2].r) == (366, 1)
    assert (rows[4].recency_days, rows[4].r, rows[4].f, rows[4].m) == (90, 5, 2, 2)
    score = {r.customer_key: r.score.asDict() for r in rfm.rfm_score(sales).collect()}
    assert score[1] == {"r": 5, "f": 1, "m": 5}


def test_priority_rises_with_value(spark):
    scored = spark.createDataFrame(
        [(i, s, m, 1, 1, Decimal(i)) for i, (s, m) in enumerate([("Lost", 3), ("Lost", 4), ("Promising", 5), ("Needing Attention", 4), ("About to Sleep", 1), ("Champions", 1), ("Unknown", 5)])],
        "customer_key long, segment string, m int, recency_days int, sales_orders_12m long, gross_sales_12m decimal(18,4)",
    )
    actions = rfm.customer_actions(scored)
    got = {r.customer_key: r.priority for r in actions.filter("intent IS NOT NULL").collect()}
    assert got == {0: "Baixa", 1: "Média", 2: "Média", 3: "Alta", 4: "Média", 5: "Alta"}
    assert actions.filter("intent IS NULL").count() == 1
    assert actions.filter("intent IS NULL").first().priority is None
    served = [r.customer_key for r in rfm.served_actions(actions).collect()]
    assert served == [5, 3, 4, 2, 1, 6, 0]


def test_eleven_actions_cover_all_segments():
    names = {name for name, _ in rfm.SEGMENT_RULES} | {rfm.OTHER_SEGMENT}
    assert {a[0] for a in rfm.ACTIONS} == names and len(rfm.ACTIONS) == 11
    assert {a[4] for a in rfm.ACTIONS} == set(rfm.PRIORITIES)
