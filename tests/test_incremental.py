"""A mart refreshed load by load equals one refreshed as a whole, and reads only what the loads touch."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from martloom.plans import incremental, refresh
from martloom.plans.contracts import CONTRACTS
from martloom.plans.incremental import STAMPS, changed_keys, merge_silver, refresh_incrementally, replace_keys
from martloom.plans.refresh import HeldBack, run_when_ready
from martloom.plans.silver import SPECS
from martloom.sinks.lake import Lake
from martloom.sinks.versions import VersionedTable


def rows_of(lake, layer, table):
    df = lake.read(layer, table)
    return Counter(map(tuple, df.select(*sorted(c for c in df.columns if c not in STAMPS)).collect()))


def assert_equal_marts(one, other):
    for layer, tables in (("silver", SPECS), ("gold", CONTRACTS)):
        for table in tables:
            assert rows_of(one, layer, table) == rows_of(other, layer, table), (layer, table)


def land(lake, table, rows, load):
    lake.table("bronze", table).append(rows, rows.schema, load, {"loads": True})


def report_of(lake):
    return {(r.layer, r.table_name): r for r in refresh_incrementally(lake, analytics=False).collect()}


@pytest.fixture
def folders(monkeypatch):
    for module in (refresh, incremental):
        monkeypatch.setattr(module, "ORDERS_PER_FOLDER", 500)


def test_three_loads_equal_one_refresh(spark, sample, tmp_path, folders):
    """The first load has most rows; the second brings new versions, old versions that must lose, and new keys; the
    third rows of the earliest year."""
    grown, whole = Lake(spark, str(tmp_path / "grown")), Lake(spark, str(tmp_path / "whole"))
    parts = F.pmod(F.xxhash64("id"), F.lit(10))
    share = {0: parts < 7, 1: parts.isin(7, 8), 2: parts == 9}
    for load, mine in share.items():
        for table in SPECS:
            land(grown, table, sample.bronze(table).filter(mine), f"load-{load}")
        report = report_of(grown)
        assert {r.outcome for (layer, _), r in report.items() if layer == "silver"} == {"merged" if load else "rebuilt"}
        if load:
            assert report["gold", "fct_sales_details"].outcome == report["gold", "fct_finance"].outcome == "merged"
    for table in SPECS:
        whole.replace(sample.bronze(table), "bronze", table)
    refresh.refresh(whole)
    assert_equal_marts(grown, whole)
    again = report_of(grown)
    assert {r.outcome for r in again.values()} == {"unchanged"}


def test_one_changed_order_touches_its_folders_only(spark, sample, tmp_path, folders):
    lake, whole = Lake(spark, str(tmp_path / "lake")), Lake(spark, str(tmp_path / "whole"))
    for table in SPECS:
        land(lake, table, sample.bronze(table), "load-0")
    report_of(lake)
    before = {t: lake.table("gold", t).version() for t in CONTRACTS}
    header = sample.bronze("sales_header")
    order = header.filter("id % 2 = 1").orderBy("id").first().asDict()
    moved = order | {"id": str(10**9), "orderdate": "05/05/1996", "customerkey": order["customerkey"]}
    late = spark.createDataFrame([moved], header.schema)
    stale = spark.createDataFrame([order | {"id": "0", "orderdate": "01/01/1993"}], header.schema)  # loses to what is there
    land(lake, "sales_header", late.unionByName(stale), "load-1")
    report = report_of(lake)
    touched = {k: r for k, r in report.items() if r.outcome != "unchanged"}
    assert set(touched) == {("silver", "sales_header"), ("gold", "fct_sales_details"), ("gold", "dim_calendar")}
    assert touched["silver", "sales_header"].rewritten <= 2 < touched["silver", "sales_header"].folders
    assert touched["gold", "fct_sales_details"].rewritten <= 2 < touched["gold", "fct_sales_details"].folders
    after = lake.table("gold", "fct_sales_details").version()
    kept = set(before["fct_sales_details"].parts) & set(after.parts)
    assert len(kept) == len(after.parts) - touched["gold", "fct_sales_details"].rewritten
    moved_rows = lake.read("gold", "fct_sales_details").filter(F.col("sales_header_key") == int(order["salesheaderkey"]))
    assert {str(r.order_date) for r in moved_rows.collect()} == {"1996-05-05"}
    for table in SPECS:
        rows = sample.bronze(table)
        whole.replace(rows.unionByName(late).unionByName(stale) if table == "sales_header" else rows, "bronze", table)
    refresh.refresh(whole)
    assert_equal_marts(lake, whole)


def test_a_dropped_row_still_beats_older_versions(spark, tmp_path):
    """The newest version breaks a rule and is dropped; an older one that arrives later must not come back."""
    lake = Lake(spark, str(tmp_path))
    schema = "id string, customerkey string, geographykey string, customer string, businesstype string, numberemployees string, annualrevenue string, yearopened string"
    row = lambda i, key, revenue: (i, key, "1", "n", "b", "1", revenue, "2000")
    for load, rows in enumerate([
        [row("5", "1", "-3"), row("1", "2", "4"), row("1", "bad", "1")],
        [row("3", "1", "9"), row("2", "2", "5"), row("9", "worse", "1")],
        [row("6", "1", "7"), row("0", "2", "1")],
    ]):
        land(lake, "customer", spark.createDataFrame(rows, schema), f"load-{load}")
        merge_silver(lake, "customer")
        seen = {r.customer_key: float(r.annual_revenue) for r in lake.read("silver", "customer").collect()}
        assert seen == [{2: 4.0}, {2: 5.0}, {1: 7.0, 2: 5.0}][load]
    assert lake.table("silver", "customer").read().count() == 4  # two unreadable keys stay apart, not shown
    assert "_kept" not in lake.read("silver", "customer").columns


def test_a_refresh_cut_short_is_continued(spark, sample, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    for table in SPECS:
        land(lake, table, sample.bronze(table).filter("id % 4 <> 3"), "load-0")
    report_of(lake)
    for table in SPECS:
        land(lake, table, sample.bronze(table).filter("id % 4 = 3"), "load-1")
    merge = incremental.merge_gold

    def failing(lake, table):
        if table == "fct_sales_details":
            raise OSError("power")
        return merge(lake, table)

    with monkeypatch.context() as m:
        m.setattr(incremental, "merge_gold", failing)
        report = {(r.layer, r.table_name): r for r in refresh_incrementally(lake).collect()}
    failed = report["gold", "fct_sales_details"]
    assert failed.outcome == "failed" and "power" in failed.message
    assert report["gold", "fct_finance"].outcome == "merged" and report["gold", "dim_customer"].outcome == "rebuilt"
    assert {report["ml", t].outcome for t in refresh.ANALYTICS} == {"held back"}
    report = report_of(lake)
    assert {t for (layer, t), r in report.items() if r.outcome != "unchanged"} == {"fct_sales_details"}
    assert {r.outcome for (layer, _), r in report.items() if layer == "silver"} == {"unchanged"}
    whole = Lake(spark, str(tmp_path / "whole"))
    for table in SPECS:
        whole.replace(sample.bronze(table), "bronze", table)
    refresh.refresh_silver(whole)
    refresh.refresh_gold(whole)
    assert_equal_marts(lake, whole)


def test_replaced_bronze_rebuilds(spark, sample, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for _ in range(2):
        lake.replace(sample.bronze("region"), "bronze", "region")
        assert merge_silver(lake, "region").outcome == "rebuilt"
    assert merge_silver(lake, "region").outcome == "unchanged"


def test_changed_keys_of_two_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, "c", 1), (None, "d", 1)], "k long, v string, _folder int")
    first = table.replace(rows, "_folder", "k")
    new = spark.createDataFrame([(2, "B", 1), (None, "e", 0)], "k long, v string, _folder int")
    replace_keys(table, first, new.select("k"), new, "k", {})
    second = table.version()
    assert {r.k for r in changed_keys(table, first, second, ["k"]).collect()} == {2, None}
    assert sorted(map(str, table.read().collect())) == sorted(map(str, spark.createDataFrame(
        [(1, "a", 0), (2, "B", 1), (3, "c", 1), (None, "e", 0)], "k long, v string, _folder int").collect()))


def test_steps_run_once_those_before_them_are_done():
    done = []
    step = lambda name, *after: (name, (after, lambda: done.append(name) or name))
    results = run_when_ready(dict([step("d", "b", "c"), step("b", "a"), step("c", "a"), step("a"), step("e")]))
    assert set(results) == set(done) == set("abcde") and done.index("a") < min(done.index("b"), done.index("c")) and done.index("d") > max(done.index("b"), done.index("c"))
    failing = {"a": ((), lambda: 1 / 0), "b": (("a",), lambda: 1), "c": (("b",), lambda: 1), "d": ((), lambda: 2)}
    results = run_when_ready(failing)
    assert results["d"] == 2 and isinstance(results["a"], ZeroDivisionError)
    assert isinstance(results["b"], HeldBack) and isinstance(results["c"], HeldBack)
    with pytest.raises(ValueError, match="each other"):
        run_when_ready({"a": (("b",), lambda: 1), "b": (("a",), lambda: 1)})
    with pytest.raises(ValueError, match="no step"):
        run_when_ready({"a": (("x",), lambda: 1)})


def test_tables_loaded_in_parts_lie_on_disk_once(spark, sf_dir):
    from martloom.registry.core import Context
    from martloom.registry.stored import _loaded_in_parts

    loaded = _loaded_in_parts(Context(spark, sf_dir))
    for layer, table in (("silver", "sales_details"), ("gold", "fct_sales_details")):
        assert len(loaded.table(layer, table).versions()) == 1


def test_a_table_that_fails_is_no_result(spark, sf_dir, monkeypatch):
    """A fact that fails in a later load is still there as of the one before: the question must not be answered from it."""
    from martloom.registry import QUERIES

    merge = incremental.merge_gold

    def failing(lake, table):
        if table == "fct_sales_details" and lake.exists("gold", table):
            raise OSError("power")
        return merge(lake, table)

    monkeypatch.setattr(incremental, "merge_gold", failing)
    with pytest.raises(RuntimeError, match="gold.fct_sales_details failed: OSError: power"):
        QUERIES["incremental_net_sales_by_year"].run(spark, sf_dir)


def test_rows_that_arrive_in_loads_are_composed_once(spark, sf_dir, sample, monkeypatch):
    from martloom.registry import stored
    from martloom.registry.core import Context
    from martloom.sources.sample import SampleTables

    made, compose = Counter(), SampleTables.bronze
    monkeypatch.setattr(SampleTables, "bronze", lambda self, table: made.update([table]) or compose(self, table))
    landed = stored._landed(Context(spark, sf_dir))
    assert made == Counter(list(SPECS))
    rows = lambda df: Counter(map(tuple, df.collect()))
    for table in ("region", "sales_returns"):
        loads = [landed[table].filter(F.col("_load") == n).drop("_load") for n in range(stored.LOADS)]
        assert sum(map(rows, loads), Counter()) == rows(compose(sample, table))


def test_loads_taken_as_a_whole_equal_one_refresh(spark, sample, tmp_path, folders, monkeypatch):
    monkeypatch.setattr(incremental, "BULK", 0)
    monkeypatch.setattr(incremental, "with_keys", lambda *_: pytest.fail("a bulk load is joined with its keys"))
    grown, whole = Lake(spark, str(tmp_path / "grown")), Lake(spark, str(tmp_path / "whole"))
    parts = F.pmod(F.xxhash64("id"), F.lit(10))
    for load, mine in enumerate((parts < 6, parts >= 6)):
        for table in SPECS:
            land(grown, table, sample.bronze(table).filter(mine), f"load-{load}")
        report = report_of(grown)
    assert report["silver", "sales_details"].outcome == "merged" and report["gold", "fct_sales_details"].outcome == "rebuilt"
    for table in SPECS:
        whole.replace(sample.bronze(table), "bronze", table)
    refresh.refresh_silver(whole)
    refresh.refresh_gold(whole)
    assert_equal_marts(grown, whole)


def test_a_bulk_load_leaves_folders_beyond_its_keys(spark, tmp_path, monkeypatch):
    """Older versions lose, dropped and unreadable rows stay as they were, and a year whose keys lie elsewhere is not rewritten."""
    monkeypatch.setattr(incremental, "BULK", 0)
    lake = Lake(spark, str(tmp_path))
    schema = "id string, finance_key string, account_key string, organization_key string, department_group_key string, scenario string, transaction_date string, amount string"
    row = lambda i, key, day, scenario="Actual", amount="1,50": (i, key, "1", "1", "1", scenario, day, amount)
    loads = [
        [row("5", "1", "01/02/1995"), row("5", "2", "01/02/1995", "Other"), row("5", "9", "01/02/1997"), row("5", "x", None), row("5", None, None)],
        [row("4", "1", "01/02/1996"), row("6", "2", "01/02/1996"), row("4", "x", None), row("7", "y", "01/02/1996"), row("6", "3", None)],
    ]
    for n, rows in enumerate(loads):
        land(lake, "finance", spark.createDataFrame(rows, schema), f"load-{n}")
        before = lake.table("silver", "finance").version()
        assert merge_silver(lake, "finance").outcome == ("merged" if n else "rebuilt")
    shown = {(r.finance_key, str(r.transaction_date)) for r in lake.read("silver", "finance").collect()}
    assert shown == {(1, "1995-02-01"), (2, "1996-02-01"), (9, "1997-02-01"), (3, "None")}
    after = lake.table("silver", "finance").version()
    kept = set(before.parts) & set(after.parts)
    assert [p.rpartition("=")[2] for p in kept] == ["1997"] and lake.table("silver", "finance").read().count() == 7
