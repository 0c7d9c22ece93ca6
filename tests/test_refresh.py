"""Bronze text to stored gold and analytics, checked end to end."""

from __future__ import annotations

import os
import shutil

import pytest
from oracle import duck
from pyspark.sql import functions as F

from martloom.plans.commercial import commercial_view
from martloom.plans.finance import finance_view
from martloom.plans.refresh import refresh, register_gold, stored_mart
from martloom.plans.rfm import customer_rfm
from martloom.plans.silver import SPECS
from martloom.registry import QUERIES
from martloom.registry.conforming import LINE_ID
from martloom.registry.oracle import compose
from martloom.sinks.lake import Lake


@pytest.fixture(scope="module")
def lake(spark, sample, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("mart")))
    for table in SPECS:
        lake.replace(sample.bronze(table), "bronze", table)
    refresh(lake)
    return lake


def test_stored_queries_see_input_that_changes_within_an_application(spark, sf_dir, tmp_path):
    folder = str(shutil.copytree(sf_dir, tmp_path / "in", copy_function=shutil.copyfile))
    os.chmod(folder, 0o755)
    regions = spark.read.parquet(f"{sf_dir}/region.parquet")
    for name in ("OLD", "NEW"):
        regions.withColumn("r_name", F.lit(name)).write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        target = tmp_path / "in" / "region.parquet"
        os.replace(next((tmp_path / name).glob("part-*")), target)  # the copied data may be read-only
        spark.catalog.refreshByPath(str(target))
        assert {r["region_name"] for r in QUERIES["named_table_scan"].run(spark, folder).collect()} == {name}


def test_net_sales_of_the_stored_mart(lake, sf_dir):
    """Stored silver dedups repeated lines and drops customers with negative revenue."""
    got = {
        r.regiao: (float(r.gross), float(r.returns), r.customers)
        for r in commercial_view(stored_mart(lake))
        .query({"gross": "Gross Sales", "returns": "Returns", "customers": "Customers Current"}, {"regiao": "Regiao"})
        .collect()
    }
    latest = f"QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ID} DESC) = 1"
    sql = """SELECT region_name, CAST(sum(gross_amount) AS DOUBLE), count(DISTINCT customer_key) FROM tx
             WHERE transaction_type = '{}' AND customer_key IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
             GROUP BY 1"""
    want = {}
    for kind, lines in (("sale", "true"), ("return", "l_returnflag = 'R'")):
        con = duck(sf_dir)
        con.execute(
            f"CREATE OR REPLACE VIEW lineitem AS SELECT * FROM '{sf_dir}/lineitem.parquet' WHERE {lines} {latest}"
        )
        want[kind] = {r[0]: r[1:] for r in con.execute(compose(sql.format(kind), ("tx",))).fetchall()}
    assert got == {
        region: (gross, want["return"][region][0], customers)
        for region, (gross, customers) in want["sale"].items()
    }


def test_one_year_reads_one_folder(lake):
    """The questions themselves prune: metric views by year, RFM by its window."""
    mart = stored_mart(lake)

    def partition_filters(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.splitlines() if "PartitionFilters" in line and "_year" in line.split("PartitionFilters")[1].split("PushedFilters")[0]]

    sales = commercial_view(mart).query({"net": "Net Sales"}, where=lambda d: d("Ano") == 1997)
    assert len(partition_filters(sales)) == 2 and sales.first().net is not None
    ledger = finance_view(mart).query({"actual": "Total Amount Actual"}, where=lambda d: d("Ano") == 1997)
    assert len(partition_filters(ledger)) == 1 and ledger.first().actual is not None
    assert partition_filters(customer_rfm(mart.gold("fct_sales_details")))


def test_analytic_tables_are_stored(lake):
    for layer, table in (("semantic", "dim_customer_rfm"), ("ml", "reco_customer_actions"), ("ml", "pvm_drivers"), ("ml", "forecast_sales")):
        assert lake.read(layer, table).count() > 0
    assert "_generated_at" in lake.read("ml", "pvm_drivers").columns
    assert "_gold_loaded_at" in lake.read("gold", "dim_customer").columns
    assert lake.read("ml", "reco_customer_actions").filter("intent IS NULL").count() == 0


def test_catalog_shows_comments_and_tags(spark, lake):
    register_gold(lake)
    columns = {r.col_name: r.comment for r in spark.sql("DESCRIBE gold.dim_customer").collect()}
    assert columns["customer_key"] == "Business key of the customer"
    extended = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED gold.dim_customer").collect()}
    assert "domain=comercial" in extended["Table Properties"] and "pii=true" in extended["Table Properties"]
    assert spark.table("gold.fct_sales_details").filter("order_year = 1997").count() > 0
    spark.sql("DROP DATABASE gold CASCADE")


def test_refresh_is_repeatable(lake):
    before = lake.read("gold", "fct_sales_details").count()
    refresh(lake)
    assert lake.read("gold", "fct_sales_details").count() == before
