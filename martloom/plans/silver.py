"""The fourteen silver tables, declared as conform specs."""

from __future__ import annotations

from martloom.operators.conform import ConformSpec, Field
from martloom.operators.quality import Expectation


def _fields(text: str) -> tuple[Field, ...]:
    """Lines of ``name source reader``."""
    return tuple(Field(*line.split()) for line in text.strip().splitlines())


def _key_rule(column: str) -> Expectation:
    return Expectation("valid_key", f"{column} IS NOT NULL", "drop")


def _not_negative(name: str, column: str, action: str = "track") -> Expectation:
    return Expectation(name, f"{column} >= 0", action)


SPECS: dict[str, ConformSpec] = {
    spec.table: spec
    for spec in (
        ConformSpec(
            "customer",
            _fields("""
                customer_key customerkey key
                geography_key geographykey key
                customer_name customer text
                business_type businesstype text
                number_employees numberemployees int
                annual_revenue annualrevenue revenue
                year_opened yearopened int
            """),
            ("customerkey",),
            (
                _key_rule("customer_key"),
                _not_negative("valid_revenue", "annual_revenue", "drop"),
            ),
        ),
        ConformSpec(
            "account",
            _fields("""
                account_key accountkey key
                account_header_key accountheaderkey key
                account_subheader_key accountsubheaderkey key
                account_name account text
                account_type accounttype text
                account_subheader accountsubheader text
                subheader_detail subheaderdetail int
                sign sign int
            """),
            ("accountkey",),
            (_key_rule("account_key"),),
        ),
        ConformSpec(
            "account_header",
            _fields("""
                account_header_key accountheaderkey key
                account_header_name accountheader text
                header_detail detail int
            """),
            ("accountheaderkey",),
            (_key_rule("account_header_key"),),
        ),
        ConformSpec(
            "organization",
            _fields("""
                organization_key organizationkey key
                organization_name organization text
                parent_organization parentorganization text
            """),
            ("organizationkey",),
            (_key_rule("organization_key"),),
        ),
        ConformSpec(
            "department_group",
            _fields("""
                department_group_key departmentgroupkey key
                department_group_name departmentgroupname text
            """),
            ("departmentgroupkey",),
            (_key_rule("department_group_key"),),
        ),
        ConformSpec(
            "geography",
            _fields("""
                geography_key geographykey key
                region_key regionkey key
                city_name cityname text
                state_code statecode text
                state_name statename text
                country_code countrycode text
                country_name countryname text
            """),
            ("geographykey",),
            (_key_rule("geography_key"),),
        ),
        ConformSpec(
            "region",
            _fields("""
                region_key regionkey key
                region_name region text
                country country text
                continent continent text
            """),
            ("regionkey",),
            (_key_rule("region_key"),),
        ),
        ConformSpec(
            "product",
            _fields("""
                product_key productkey key
                product_subcategory_key productsubcategorykey key
                product_name productname text
                size Size text
                detail detail text
            """),
            ("productkey",),
            (_key_rule("product_key"),),
        ),
        ConformSpec(
            "product_sub_category",
            _fields("""
                product_subcategory_key productsubcategorykey key
                subcategory_name subcategoryname text
                category_name categoryname text
            """),
            ("productsubcategorykey",),
            (_key_rule("product_subcategory_key"),),
        ),
        ConformSpec(
            "finance",
            _fields("""
                finance_key finance_key key
                account_key account_key key
                organization_key organization_key key
                department_group_key department_group_key key
                scenario scenario lower
                transaction_date transaction_date date
                amount amount money
            """),
            ("finance_key",),
            (
                _key_rule("finance_key"),
                Expectation("valid_scenario", "scenario IN ('actual', 'budget')", "drop"),
            ),
        ),
        ConformSpec(
            "sales_header",
            _fields("""
                sales_header_key salesheaderkey key
                customer_key customerkey key
                region_key regionkey key
                sales_order_number salesordernumber text
                order_date orderdate date
                due_date duedate date
                ship_date shipdate date
                discount_amount discountamount money
                total_amount totalamount money
                sales_amount salesamount money
            """),
            ("salesheaderkey",),
            (_key_rule("sales_header_key"), _not_negative("valid_total", "total_amount")),
        ),
        ConformSpec(
            "sales_details",
            _fields("""
                sales_details_key salesdetailskey key
                sales_header_key salesheaderkey key
                product_key productkey key
                product_subcategory_key productsubcategorykey key
                sales_order_number salesordernumber text
                order_quantity orderquantity int
                unit_price unitprice money
                extended_amount extendedamount money
            """),
            ("salesdetailskey",),
            (
                _key_rule("sales_details_key"),
                _not_negative("valid_quantity", "order_quantity"),
                _not_negative("valid_price", "unit_price"),
            ),
        ),
        ConformSpec(
            "sales_returns",
            _fields("""
                return_key returnkey key
                customer_key customerkey key
                product_key productkey key
                sales_order_number salesordernumber text
                return_date returndate date
                order_date orderdate date
                return_quantity returnquantity int
                unit_price unitprice money
                return_amount returnamount money
            """),
            ("returnkey",),
            (_key_rule("return_key"), _not_negative("valid_quantity", "return_quantity")),
        ),
        ConformSpec(
            "product_cost_history",
            _fields("""
                product_key productkey key
                country_code countrycode text
                year Year int
                month_no monthno int
                unit_cost unitcost money
            """),
            ("Year", "monthno", "productkey", "countrycode"),
            (
                Expectation("valid_product", "product_key IS NOT NULL", "drop"),
                _not_negative("valid_cost", "unit_cost"),
            ),
        ),
    )
}
