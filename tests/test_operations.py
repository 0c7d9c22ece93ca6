from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal
from random import Random

import pytest
from pyspark.sql import functions as F

from martloom.operators import checks, policy
from martloom.operators.intervals import interval_join
from martloom.plans import usage
from martloom.sinks.lake import Lake
from martloom.sinks.relational import MANIFEST, JdbcTarget, LakeTarget, Publication, manifest_rows, publish, reconcile

T0 = datetime(2024, 1, 1)


def _usage(spark, rows):
    return spark.createDataFrame(rows, "sku_name string, start_t timestamp_ntz, end_t timestamp_ntz, n int")


def _join(facts, periods, bucket_days):
    return interval_join(facts, periods, "sku_name", ("start_t", "end_t"), ("p_from", "p_to"), bucket_days)


PERIODS = "sku_name string, p_from timestamp_ntz, p_to timestamp_ntz, price int"


@pytest.mark.parametrize("bucket_days", [None, 1, 7, 400])
def test_interval_join_edges(spark, bucket_days):
    h = timedelta(hours=1)
    change = T0 + timedelta(days=14)
    periods = spark.createDataFrame([("a", T0, change, 1), ("a", change, None, 2), ("b", change, None, 3)], PERIODS)
    facts = _usage(
        spark,
        [
            ("a", T0, T0 + h, 1),  # starts with the period
            ("a", change - h, change, 2),  # ends with the period
            ("a", change - h, change + h, 3),  # straddles the change
            ("a", change, change + h, 4),
            ("a", T0 - h, T0, 5),  # before any period
            ("b", T0, T0 + h, 6),  # its sku is not priced yet
            ("b", change + 500 * 24 * h, change + 500 * 24 * h + h, 7),  # far into the open period
            ("c", T0, T0 + h, 8),  # unknown sku
        ],
    )
    got = {(r.n, r.price) for r in _join(facts, periods, bucket_days).collect()}
    assert got == {(1, 1), (2, 1), (4, 2), (7, 3)}


@pytest.mark.parametrize("bucket_days", [None, 3])
def test_interval_join_against_brute_force(spark, bucket_days):
    rnd = Random(5)
    at = lambda: T0 + timedelta(minutes=rnd.randrange(60 * 24 * 60))
    facts = []
    for i in range(300):
        start = at()
        facts.append(("hot" if i % 3 == 0 else f"s{i % 5}", start, start + timedelta(minutes=rnd.randrange(600)), i))
    periods = []
    for i in range(60):
        start = at()
        end = None if i % 7 == 0 else start + timedelta(minutes=rnd.randrange(20000))
        periods.append((["hot", "s0", "s1", "s2", "s3", "s4"][i % 6], start, end, i))
    want = sorted(
        (f[3], p[3]) for f in facts for p in periods
        if f[0] == p[0] and f[1] >= p[1] and (p[2] is None or f[2] <= p[2])
    )
    joined = _join(_usage(spark, facts), spark.createDataFrame(periods, PERIODS), bucket_days)
    assert sorted((r.n, r.price) for r in joined.collect()) == want


def test_window_of_thirty_days_includes_its_edge(spark):
    days = spark.createDataFrame([(date(2024, 1, 11),), (date(2024, 1, 10),)], "d date")
    kept = days.filter(usage.since(F.col("d"), F.lit("2024-02-10").cast("date")))
    assert [r.d for r in kept.collect()] == [date(2024, 1, 11)]


def test_missing_tag_is_its_own_group(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), {"k": "x"}, Decimal(1)), (date(2024, 1, 1), {}, Decimal(2))],
        "usage_date date, custom_tags map<string,string>, usage_quantity decimal(18,2)",
    )
    rows = usage.usage_by_tag(df, "k", F.lit("2024-01-02").cast("date")).collect()
    assert {(r.dominio, float(r.qtd)) for r in rows} == {("x", 1.0), (None, 2.0)}


GEO = [(1, "N"), (2, "S"), (3, "W"), (4, None)]


def _grants(spark):
    return spark.createDataFrame([("a@x", "N"), ("b@x", "N"), ("b@x", "S"), ("b@x", "S")], policy.GRANTS_SCHEMA)


@pytest.mark.parametrize(
    ("who", "admin", "seen"), [("a@x", False, {1}), ("b@x", False, {1, 2}), ("nobody@x", False, set()), ("nobody@x", True, {1, 2, 3, 4})]
)
def test_row_filter(spark, who, admin, seen):
    geo = spark.createDataFrame(GEO, "geography_key int, region_name string")
    assert {r.geography_key for r in policy.row_filter(geo, "region_name", _grants(spark), who, admin).collect()} == seen
    policy.register_policy_functions(spark, _grants(spark), who, admin)
    geo.createOrReplaceTempView("geo_seen")
    assert {r.geography_key for r in spark.sql("SELECT * FROM geo_seen WHERE rls_region(region_name)").collect()} == seen


def test_principal_is_only_ever_a_value(spark):
    policy.register_policy_functions(spark, _grants(spark), "x' OR 'a' = 'a", False)
    spark.createDataFrame(GEO, "geography_key int, region_name string").createOrReplaceTempView("geo_seen")
    assert spark.sql("SELECT * FROM geo_seen WHERE rls_region(region_name)").count() == 0


def test_mask_keeps_the_type(spark):
    df = spark.createDataFrame([(Decimal("5.00"),)], "v decimal(18,2)")
    hidden = df.select(policy.mask(F.col("v"), False).alias("v"))
    assert hidden.dtypes == df.dtypes and hidden.first().v is None
    assert df.select(policy.mask(F.col("v"), True).alias("v")).first().v == Decimal("5.00")
    for admin, value in ((True, Decimal("5.00")), (False, None)):
        policy.register_policy_functions(spark, _grants(spark), "a@x", admin)
        assert spark.sql("SELECT mask_revenue(CAST(5 AS DECIMAL(18,2))) AS v").first().v == value


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    assert [(r.k, r.n) for r in checks.grain_violations(df, ["k"]).collect()] == [(1, 2)]
    row = checks.grain_summary([("t", df, ["k"])]).first()
    assert (row.total_rows, row.distinct_keys, row.duplicated_keys) == (3, 2, 1)
    row = checks.null_share(df, "v").first()
    assert (row.linhas_venda, row.sem_custo, row.pct_sem_custo) == (3, 1, 33.3)
    assert checks.null_share(df.limit(0), "v").first().pct_sem_custo is None
    profile = checks.key_profile(df, "k").first()
    assert (profile.total, profile.distintos) == (3, 2)
    both = checks.side_by_side(F.sum("k"), df, F.count("v"), df).first()
    assert (both.left_total, both.right_total, both.difference) == (4, 2, 2)


CONNECTION = {"url": "jdbc:postgresql://db:5432/dw", "user": "u", "password": "p", "driver": "org.postgresql.Driver"}


def test_jdbc_target_truncates_and_bounds_connections(spark):
    options = JdbcTarget(spark, CONNECTION, max_connections=4).write_options("gold.dim_customer")
    assert options["truncate"] == "true" and options["batchsize"] == "5000" and options["numPartitions"] == "4"
    assert options["dbtable"] == "gold.dim_customer"


def test_manifest(spark):
    assert len(MANIFEST) == 16 and len({m.destination for m in MANIFEST}) == 16
    rows = {r.source: r for r in manifest_rows(spark).collect()}
    assert rows["dim_calendar"].unique_keys == [["full_date"]]
    assert rows["fct_product_cost_history"].primary_key == ["product_key", "year", "month_no", "country_code"]
    assert rows["reco_customer_actions"].indexes == ["segment", "priority"]


def test_reconcile_finds_divergence(spark, tmp_path):
    manifest = [Publication("a", "gold.a", ("id",)), Publication("b", "gold.b", ("id",))]
    target = LakeTarget(Lake(spark, str(tmp_path)))
    written = publish(lambda t: spark.range(3), target, manifest)
    assert set(written.values()) == {3}
    wrong = {d: n if d.endswith("a") else n + 1 for d, n in written.items()}
    report = reconcile(spark, wrong, target).collect()
    assert [(r.table_name, r.source_rows, r.target_rows, r.status) for r in report] == [
        ("gold.b", 4, 3, "DIVERGE"), ("gold.a", 3, 3, "OK"),
    ]


def test_registered_table_carries_comment_and_tags(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.replace(spark.range(3), "shown", "t")
    lake.register("shown", "t", "it's a table", {"domain": "comercial"})
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED shown.t").collect()}
    assert described["Comment"] == "it's a table" and "domain=comercial" in described["Table Properties"]
    assert spark.table("shown.t").count() == 3
    spark.sql("DROP DATABASE shown CASCADE")
