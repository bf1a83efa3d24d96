"""Flat sales mart and the reports on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.operators.lookup import lookup
from basketry.sources.schemas import contract

NOT_LISTED = "Not In Catalog"


def sales_mart(fact: DataFrame, dim_date: DataFrame, dim_product: DataFrame,
               dim_location: DataFrame, dim_currency: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Fact rows with the attributes of their dimensions; no customer attributes.

    Products come first: where they are too many to broadcast, only the fact's own columns are shuffled.
    """
    df = lookup(fact, dim_product.select(
        "product_key", "product_id", "product_name", "product_sku", "product_gender"), "product_key")
    df = lookup(df, dim_date.select(
        "date_key", "full_date", "year_number", "quarter_number", "month_number", "month_name",
        "day_name", "is_weekend"), "date_key")
    df = lookup(df, dim_currency.select("currency_key", "currency_code"), "currency_key")
    df = lookup(df, dim_store.select("store_key", "store_domain"), "store_key")
    df = lookup(df, dim_location.select(
        "location_key", "location_city_name", "location_region_name", "location_country_name",
        "location_country_code"), "location_key")
    computed = {
        "order_timestamp": F.col("timestamp"),
        "product_name": F.coalesce("product_name", F.lit(NOT_LISTED)),
        "product_gender": F.coalesce("product_gender", F.lit(NOT_LISTED)),
        "sales_local_price": F.col("sales_local_price").cast("double"),
        "sales_usd_price": F.col("sales_usd_price").cast("double"),
        "total_revenue_usd": (F.col("sales_amount") * F.col("sales_usd_price")).cast("double"),
    }
    return df.select(*[
        computed.get(name, F.col(name)).alias(name)
        for name in contract("mart_sales_order_detail").names
    ])


def revenue() -> Column:
    """Summed on cents, so that the order of the rows cannot change the total."""
    return F.sum(F.col("total_revenue_usd").cast("decimal(20,2)")).cast("double").alias("revenue_usd")


def _measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("line_count"), F.sum("sales_amount").alias("units"), revenue()]


def revenue_by_period(mart: DataFrame) -> DataFrame:
    """Month, quarter and year totals and the grand total; null marks a rolled-up level."""
    return mart.rollup("year_number", "quarter_number", "month_number").agg(*_measures())


def revenue_by_place(mart: DataFrame) -> DataFrame:
    return mart.groupBy(
        "location_country_name", "location_region_name", "location_city_name"
    ).agg(*_measures())


def top_products(mart: DataFrame, n: int) -> DataFrame:
    totals = mart.groupBy("product_id", "product_name").agg(*_measures())
    return totals.orderBy(F.desc("revenue_usd"), F.asc_nulls_first("product_id")).limit(n)


def revenue_by_day_type(mart: DataFrame) -> DataFrame:
    return mart.groupBy("is_weekend").agg(*_measures())
