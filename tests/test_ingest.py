from __future__ import annotations

import json
import shutil
from datetime import date

import pytest
from pyspark.sql import functions as F

from martloom.sinks.lake import Lake
from martloom.sinks.versions import VersionedTable
from martloom.sources import jdbc, landing
from martloom.sources.ingest import BRONZE, UnknownHistory, auto_load, copy_into, full_load, ingest, reload, rescued_rows, stored_rows
from martloom.streaming.drift import merged_schema
from martloom.streaming.file_stream import append_available, file_stream, stored_schema


def _land(spark, folder, rows, schema="id int, name string"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_copy_into_takes_each_file_once(spark, tmp_path):
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    _land(spark, src, [(1, "a"), (2, "b")])
    for expected in (2, 2):
        copy_into(lake, "t", src)
        assert stored_rows(lake, "t") == expected
    _land(spark, src, [(3, "c")])
    copy_into(lake, "t", src)
    assert sorted(r.id for r in lake.read(BRONZE, "t").collect()) == [1, 2, 3]


def test_new_column_in_a_later_batch(spark, tmp_path):
    for load, name in ((copy_into, "c"), (auto_load, "a")):
        lake, src = Lake(spark, str(tmp_path / f"lake{name}")), str(tmp_path / f"landing{name}")
        _land(spark, src, [(1, "a")])
        load(lake, "t", src)
        _land(spark, src, [(2, "b", 9)], "id int, name string, extra int")
        load(lake, "t", src)
        rows = {r.id: r.extra for r in lake.read(BRONZE, "t").collect()}
        assert rows == {1: None, 2: 9}


def test_stored_schema_keeps_columns_that_stop_arriving(spark, tmp_path):
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    _land(spark, f"{src}/1", [(1, "a")])
    auto_load(lake, "t", f"{src}/*")
    stored = json.loads(spark.read.text(lake.schema_location("t"), wholetext=True).first()[0])
    assert [f["name"] for f in stored["fields"]] == ["id", "name"]


def test_merged_schema_appends_new_columns(spark):
    old = spark.createDataFrame([], "a int, b int").schema
    new = spark.createDataFrame([], "c int, a int").schema
    assert merged_schema(old, new).fieldNames() == ["a", "b", "c"]


def test_stream_resumes_in_small_steps(spark, tmp_path):
    src = str(tmp_path / "landing")
    for i in range(5):
        _land(spark, src, [(i, "x")])
    schema = spark.read.parquet(src).schema
    append_available(file_stream(spark, src, schema, max_files=1), str(tmp_path / "out"), str(tmp_path / "chk"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_full_load_replaces_rows_and_schema(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    _land(spark, str(tmp_path / "one"), [(1, "a")])
    _land(spark, str(tmp_path / "two"), [(7, 8.5)], "id int, price double")
    full_load(lake, "t", str(tmp_path / "one"))
    full_load(lake, "t", str(tmp_path / "two"))
    assert lake.read(BRONZE, "t").columns == ["id", "price"]
    assert reload(lake, "t", str(tmp_path / "two")) == 1


def test_switching_load_type_never_doubles_rows(spark, tmp_path):
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    _land(spark, src, [(1, "a"), (2, "b")])
    for load in (full_load, copy_into, copy_into, full_load, auto_load):
        load(lake, "t", src)
        assert lake.read(BRONZE, "t").count() == 2


def test_rows_of_unknown_origin_stay(spark, tmp_path):
    """A table without a checkpoint keeps its rows: the load refuses, and only ``reset`` replaces them."""
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    lake.replace(spark.range(1000).select(F.col("id").cast("int"), F.lit("old").alias("name")), BRONZE, "t")
    _land(spark, src, [(1, "a"), (2, "b"), (3, "c")])
    with pytest.raises(UnknownHistory):
        copy_into(lake, "t", src)
    assert stored_rows(lake, "t") == 1000
    copy_into(lake, "t", src, reset=True)
    assert stored_rows(lake, "t") == 3


@pytest.mark.parametrize("first", [full_load, copy_into, auto_load])
def test_a_lost_checkpoint_neither_loses_nor_doubles(spark, tmp_path, first):
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    _land(spark, src, [(1, "a"), (2, "b")])
    first(lake, "t", src)
    shutil.rmtree(lake.checkpoint("t"), ignore_errors=True)
    _land(spark, src, [(3, "c")])
    assert copy_into(lake, "t", src) == 1
    assert copy_into(lake, "t", src) == 0
    assert sorted(r.id for r in lake.read(BRONZE, "t").collect()) == [1, 2, 3]


def test_a_write_that_fails_leaves_the_old_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.replace(spark.range(5), "gold", "t")
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        lake.replace(broken, "gold", "t")
    assert lake.read("gold", "t").count() == 5
    lake.replace(lake.read("gold", "t").filter("id > 1"), "gold", "t")  # a table may feed its own successor
    assert lake.read("gold", "t").count() == 3


def test_widened_and_clashing_types(spark, tmp_path):
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    _land(spark, src, [(1, "a")])
    auto_load(lake, "t", src)
    _land(spark, src, [(1 << 40, "b")], "id long, name string")
    auto_load(lake, "t", src)
    assert stored_schema(spark, lake.schema_location("t"))["id"].dataType.simpleString() == "bigint"
    assert sorted(r.id for r in lake.read(BRONZE, "t").collect()) == [1, 1 << 40]
    _land(spark, src, [("x", "c"), ("7", "d")], "id string, name string")
    assert auto_load(lake, "t", src) == 2
    rows = {r.name: (r.id, r["_rescued"]) for r in lake.read(BRONZE, "t").collect()}
    assert rows["a"] == (1, None) and rows["b"] == (1 << 40, None) and rows["d"] == (7, None)
    assert rows["c"][0] is None and rows["c"][1]["id"] == "x" and rows["c"][1]["_file"].endswith(".parquet")
    assert stored_schema(spark, lake.schema_location("t"))["id"].dataType.simpleString() == "bigint"


def test_no_value_is_lost_whatever_arrives(spark, tmp_path):
    """One load of files that disagree: fractions for whole numbers, text, arrays, and a column that only one has."""
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    for i, (rows, schema) in enumerate([
        ([(1, 10, "2024-01-31")], "id int, n int, day string"),
        ([(2, 2.0, "x"), (3, 2.5, None)], "id int, n double, day string"),
        ([(4, "4", "y"), (5, "four", "z"), (6, None, "z")], "id int, n string, day string"),
        ([(7, [1, 2], "z")], "id int, n array<int>, day string"),
        ([(8, 1 << 40, "z", "more")], "id int, n long, day string, extra string"),
    ]):
        _land(spark, f"{src}/{i}", rows, schema)
    for load in (copy_into, full_load, copy_into):
        load(lake, "t", f"{src}/*")
        rows = {r.id: r for r in lake.read(BRONZE, "t").collect()}
        assert {i: r.n for i, r in rows.items()} == {1: 10, 2: 2, 3: None, 4: 4, 5: None, 6: None, 7: None, 8: 1 << 40}
        lost = {i: r["_rescued"]["n"] for i, r in rows.items() if r["_rescued"] is not None}
        assert lost == {3: "2.5", 5: "four", 7: "[1,2]"} and rows[8].extra == "more"
    assert rescued_rows(lake, "t") == 3


def test_rescued_rows_are_reported(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    control = spark.createDataFrame(
        [("t", "t", "incremental", "autoloader", True)],
        "source_table string, target_folder string, load_type string, ingestion_mode string, is_active boolean",
    )
    for rows, schema, rescued in (([(1, "a")], "id int, name string", 0), ([("?", "b"), ("2", "c")], "id string, name string", 1)):
        _land(spark, str(tmp_path / "landing" / "t"), rows, schema)
        row = ingest(lake, control, lambda f: str(tmp_path / "landing" / f)).first()
        assert (row.status, row.rescued_rows) == ("loaded", rescued)
    assert row.rows_after == 3


def test_a_load_cut_short_before_its_version_is_done_again(spark, tmp_path, monkeypatch):
    """Rows and ledger are written, the version is not: neither counts, and the next run brings every row once."""
    lake, src = Lake(spark, str(tmp_path / "lake")), str(tmp_path / "landing")
    _land(spark, src, [(1, "a")])
    copy_into(lake, "t", src)
    _land(spark, src, [(2, "b")])
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "commit", lambda *_: (_ for _ in ()).throw(OSError("no")))
        for load in (copy_into, full_load):
            with pytest.raises(Exception):
                load(lake, "t", src)
            assert lake.read(BRONZE, "t").count() == 1
    assert copy_into(lake, "t", src) == 1
    assert sorted(r.id for r in lake.read(BRONZE, "t").collect()) == [1, 2]


def test_one_failing_table_stops_no_other(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    _land(spark, str(tmp_path / "landing" / "a"), [(1, "a")])
    control = spark.createDataFrame(
        [("a", "a", "incremental", "copy_into", True), ("gone", "gone", "full", "copy_into", True)],
        "source_table string, target_folder string, load_type string, ingestion_mode string, is_active boolean",
    )
    report = {r.source_table: r for r in ingest(lake, control, lambda f: str(tmp_path / "landing" / f)).collect()}
    assert (report["a"].status, report["a"].rows_after) == ("loaded", 1)
    assert report["gone"].status == "failed" and "gone" in report["gone"].message


def test_dispatcher_reports_every_row(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    for t in ("a", "b", "c", "d", "e", "f"):
        _land(spark, str(tmp_path / "landing" / t), [(1, t), (2, t)])
    control = spark.createDataFrame(
        [
            ("a", "a", "full", "copy_into", True),
            ("b", "b", "incremental", "copy_into", True),
            ("c", "c", "incremental", "autoloader", True),
            ("d", "d", "monthly", "copy_into", True),
            ("e", "e", "incremental", "carrier pigeon", True),
            ("f", "f", "full", "copy_into", False),
        ],
        "source_table string, target_folder string, load_type string, ingestion_mode string, is_active boolean",
    )
    for before in (0, 2):
        report = {r.source_table: r for r in ingest(lake, control, lambda f: str(tmp_path / "landing" / f)).collect()}
        assert {t: r.status for t, r in report.items()} == {"a": "loaded", "b": "loaded", "c": "loaded", "d": "skipped", "e": "skipped"}
        assert [(report[t].rows_before, report[t].rows_after) for t in "abc"] == [(before, 2)] * 3


def test_control_table_defaults(spark):
    tables = {
        "orders": spark.createDataFrame([], "id int, Updated_At timestamp, modified_by string"),
        "nation": spark.createDataFrame([], "id int"),
    }
    columns = landing.discover_columns(spark, tables)
    rows = {r.source_table: r for r in landing.control_table(columns).collect()}
    assert (rows["orders"].load_type, rows["orders"].watermark_column) == ("incremental", "Updated_At")
    assert (rows["nation"].load_type, rows["nation"].watermark_column) == ("full", None)
    assert rows["nation"].ingestion_mode == "copy_into" and rows["nation"].is_active


def test_control_json(spark, tmp_path):
    control = landing.control_table(landing.discover_columns(spark, {"nation": spark.createDataFrame([], "id int")}))
    assert json.loads(landing.control_json(control).first().document)["load_type"] == "full"
    landing.write_control_json(control, str(tmp_path / "c"))
    assert spark.read.json(str(tmp_path / "c")).count() == 1


def test_catalog_discovery(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS found")
    spark.sql("CREATE TABLE IF NOT EXISTS found.orders (id INT, updated_at DATE) USING parquet")
    columns = landing.discover_catalog(spark, "found")
    assert {(r.table_name, r.column_name) for r in columns.collect()} == {("orders", "id"), ("orders", "updated_at")}
    spark.sql("DROP DATABASE found CASCADE")


def test_dated_folders(spark, tmp_path):
    day = landing.dated_folder(str(tmp_path), "erp", "orders", date(2024, 3, 9))
    assert day.endswith("/erp/orders/2024/03/09")
    _land(spark, day, [(1, "a")])
    _land(spark, landing.dated_folder(str(tmp_path), "erp", "orders", date(2024, 3, 10)), [(2, "b")])
    pattern = landing.all_days(str(tmp_path), "erp", "orders")
    assert landing.scan_parquet(spark, pattern).count() == 2
    lake = Lake(spark, str(tmp_path / "lake"))
    copy_into(lake, "orders", pattern)
    copy_into(lake, "orders", pattern)
    assert stored_rows(lake, "orders") == 2


def test_landing_files(spark, tmp_path):
    _land(spark, str(tmp_path / "t"), [(1, "a"), (2, "b")])
    row = landing.landing_files(spark, str(tmp_path / "t")).first()
    assert row.file_rows == 2 and row.file_bytes > 0 and row.file_name.endswith(".parquet")


def test_files_of_one_name_and_empty_files_are_listed(spark, tmp_path):
    for day, rows in (("1", [(1, "a"), (2, "b")]), ("2", [(3, "c")]), ("3", [])):
        _land(spark, str(tmp_path / "t" / day), rows)
        written = next((tmp_path / "t" / day).glob("part-*.parquet"))
        written.rename(written.with_name("same.parquet"))
    rows = landing.landing_files(spark, str(tmp_path / "t")).collect()
    assert sorted((r.file_name, r.file_rows) for r in rows) == [("same.parquet", 0), ("same.parquet", 1), ("same.parquet", 2)]
    assert len({r.file_path for r in rows}) == 3
    assert landing.landed_tables(spark, str(tmp_path)) == []


def test_marks_keep_the_time_of_day(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES (1, TIMESTAMP '2024-01-01 08:00:00'), (2, TIMESTAMP '2024-01-01 20:00:00') t(id, updated_at)")
    where = str(tmp_path / "marks")
    assert landing.stored_mark(spark, where, "t") is None
    assert landing.rows_since(df, "updated_at", None).count() == 2
    for part, left in ((df.filter("id = 1"), [2]), (df, [])):
        landing.store_marks(landing.load_state({"t": part}, {"t": "updated_at"}), where)
        assert [r.id for r in landing.rows_since(df, "updated_at", landing.stored_mark(spark, where, "t")).collect()] == left


CONNECTION = {"url": "jdbc:postgresql://db:5432/shop", "user": "u", "password": "p", "driver": "org.postgresql.Driver"}


def test_jdbc_read_options():
    options = jdbc.query_options(CONNECTION, jdbc.columns_query())
    assert "BASE TABLE" in options["query"] and "'pg_catalog'" in options["query"] and "dbtable" not in options
    split = jdbc.table_options(CONNECTION, "dbo.orders", ("id", 1, 1000, 16))
    assert (split["dbtable"], split["partitionColumn"], split["numPartitions"]) == ("dbo.orders", "id", "16")
