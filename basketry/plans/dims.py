"""Dimensions.  All but the calendar carry a row for the unknown member, key -1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.dates import date_key, is_weekend, sunday_week
from basketry.functions.keys import UNKNOWN_KEY, mask_email
from basketry.operators.lookup import with_row

AUTHOR = "dbt"  # fixed value
AUDIT = ["inserted_date", "inserted_by", "updated_date", "updated_by"]


def audit_columns() -> list[Column]:
    now, author = F.current_timestamp(), F.lit(AUTHOR)
    return [now.alias(AUDIT[0]), author.alias(AUDIT[1]), now.alias(AUDIT[2]), author.alias(AUDIT[3])]


def _audited(df: DataFrame) -> DataFrame:
    return df.select("*", *audit_columns())


def _known(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key) != UNKNOWN_KEY)


def date(cart_items: DataFrame) -> DataFrame:
    """Every day from the first to the last order."""
    bounds = cart_items.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    days = bounds.select(F.explode(F.sequence("first", "last")).alias("full_date"))
    day = F.col("full_date")
    return _audited(days.select(
        date_key(day).alias("date_key"),
        day,
        F.dayofweek(day).cast("bigint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.dayofyear(day).cast("bigint").alias("day_of_year"),
        sunday_week(day).cast("bigint").alias("week_of_year"),
        F.month(day).cast("bigint").alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).cast("bigint").alias("quarter_number"),
        F.year(day).cast("bigint").alias("year_number"),
        is_weekend(day).alias("is_weekend"),
    ))


def customer(cart_items: DataFrame) -> DataFrame:
    """Customers with the attributes of their latest event.

    First day and latest attributes come from one aggregate, combined map-side, so a
    customer with very many events never gathers in one task.
    """
    attributes = F.struct("user_agent", "user_id_db", "device_id", "email_address")
    recency = F.struct("event_timestamp", "source_event_id", "item_index")
    latest = (
        cart_items.where(F.col("user_id_db").isNotNull())
        .groupBy("customer_key")
        .agg(F.max_by(attributes, recency).alias("last"), F.min("order_date").alias("start_date"))
    )
    rows = latest.select(
        "customer_key",
        F.col("last.user_agent").alias("customer_user_agent"),
        F.col("last.user_id_db").alias("customer_user_id_db"),
        F.col("last.device_id").alias("customer_device_id"),
        mask_email("last.email_address").alias("customer_email_address"),
        "start_date",
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_current"),
    )
    return _audited(with_row(
        rows, customer_key=UNKNOWN_KEY, customer_user_id_db="UNKNOWN", is_current=True
    ))


def product(staged: DataFrame) -> DataFrame:
    prices = ["product_base_price", "product_min_price", "product_max_price"]
    zero = F.lit(0).cast("decimal(38,9)")
    rows = staged.select(
        "product_key", "product_id", "product_name", "product_sku", "product_gender",
        *[F.coalesce(p, zero).alias(p) for p in prices],
    )
    return _audited(with_row(
        rows, product_key=UNKNOWN_KEY, product_id=-1, product_name="UNKNOWN",
        product_gender="Unknown", **dict.fromkeys(prices, 0),
    ))


def location(staged: DataFrame) -> DataFrame:
    """Distinct places, not addresses."""
    rows = _known(staged, "location_key").select(
        "location_key",
        F.col("city_name").alias("location_city_name"),
        F.col("region_name").alias("location_region_name"),
        F.col("country_name").alias("location_country_name"),
        F.col("country_code").alias("location_country_code"),
    ).distinct()
    return _audited(with_row(rows, location_key=UNKNOWN_KEY, location_country_name="Unknown"))


def currency(staged: DataFrame) -> DataFrame:
    """Distinct ISO codes; several symbols may stand for one code."""
    rows = _known(staged, "currency_key").select(
        "currency_key", "currency_code", "currency_name"
    ).distinct()
    return _audited(with_row(
        rows, currency_key=UNKNOWN_KEY, currency_code="UNK", currency_name="Unknown"
    ))


def store(staged: DataFrame) -> DataFrame:
    rows = staged.select("store_key", F.col("store_id").cast("bigint").alias("store_id"), "store_domain")
    return _audited(with_row(rows, store_key=UNKNOWN_KEY, store_id=-1, store_domain="unknown"))
