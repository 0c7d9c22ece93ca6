"""Row filters and column masks, decided by an explicit principal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.plans.mart import Mart

GRANTS_SCHEMA = "email string, region string"


def row_filter(
    df: DataFrame, column: str, grants: DataFrame, principal: str, is_admin: bool = False
) -> DataFrame:
    """Everything for an administrator, else only rows whose value is granted to the principal."""
    if is_admin:
        return df
    granted = grants.filter(F.col("email") == principal).select(F.col("region").alias(column))
    return df.join(granted, column, "left_semi").select(*df.columns)


def mask(column: Column, is_admin: bool) -> Column:
    """The value for an administrator, NULL of the same type for anyone else."""
    return F.when(F.lit(is_admin), column)


def restricted(mart: Mart, grants: DataFrame, principal: str, is_admin: bool = False) -> Mart:
    """The mart as a principal sees it.

    The filter sits on the geography dimension, which sales and returns both join, so one
    filter restricts both facts; revenue is masked on the customer dimension.
    """

    def table(name: str) -> DataFrame:
        df = mart.gold(name)
        if name == "dim_geography":
            return row_filter(df, "region_name", grants, principal, is_admin)
        if name == "dim_customer":
            return df.withColumn("annual_revenue", mask(F.col("annual_revenue"), is_admin))
        return df

    return mart.over(table)


def register_policy_functions(
    spark: SparkSession, grants: DataFrame, principal: str, is_admin: bool, view: str = "region_grants"
) -> None:
    """SQL sugar: temporary functions ``rls_region(name)`` and ``mask_revenue(value)``."""
    grants.createOrReplaceTempView(view)
    admin = "true" if is_admin else "false"
    who = principal.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION rls_region(region_name STRING) RETURNS BOOLEAN
            RETURN {admin} OR region_name IN (SELECT region FROM {view} WHERE email = '{who}')"""
    )
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION mask_revenue(v DECIMAL(18,2)) RETURNS DECIMAL(18,2)
            RETURN CASE WHEN {admin} THEN v END"""
    )
