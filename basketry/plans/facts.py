"""Facts."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.dates import date_key
from basketry.functions.keys import UNKNOWN_KEY, joined_key, or_unknown
from basketry.functions.numbers import usd_price
from basketry.operators.lookup import every_pair, lookup
from basketry.plans.dims import audit_columns

LOOK_BACK_DAYS = 3
# One key per (order, product), null for an order without an id, which never matches.  The
# key is a hash of 60 bits; with the order beside it, lines of different orders cannot meet.
MERGE_KEYS = ["order_id", "order_product_key"]
FACT_PARTITION = "date_key"
# What the sales fact needs of a cart item.
CART_COLUMNS = ["order_id", "product_id", "item_index", "customer_key", "ip", "store_id", "order_date", "local_time",
                "event_timestamp", "amount", "unit_price", "currency_code"]


def distinct_rates(currency_rates: DataFrame) -> DataFrame:
    return currency_rates.select("currency_code", "rate_to_usd").distinct()


def exchange_rate(dim_date: DataFrame, dim_currency: DataFrame, currency_rates: DataFrame) -> DataFrame:
    """Rate of every known currency on every day (the seed holds one rate for all days)."""
    known = dim_currency.where(F.col("currency_key") != UNKNOWN_KEY).select(
        "currency_key", "currency_code"
    )
    rated = known.join(distinct_rates(currency_rates), "currency_code").select(
        "currency_key", "currency_code", F.col("rate_to_usd").cast("decimal(38,9)").alias("rate_to_usd")
    )
    return every_pair(dim_date.select("date_key").distinct(), rated).select(
        joined_key(F.col("date_key"), F.col("currency_code")).alias("exchange_rate_key"),
        "date_key", "currency_key", "rate_to_usd",
    )


def recent(cart_items: DataFrame, as_of: datetime.date | Column | None = None,
           days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Lines of the look-back window; late rows older than that are left out."""
    today = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return cart_items.where(F.col("order_date") >= F.date_sub(today, days))


def sales_order_detail(cart_items: DataFrame, location: DataFrame, dim_currency: DataFrame,
                       store: DataFrame, products: DataFrame, currency_rates: DataFrame) -> DataFrame:
    """Cart items with the keys of their dimensions and prices in US dollars.

    Small lookups come first; the address lookup, the only one that grows with the
    number of visitors, comes last.
    """
    known_currency = dim_currency.where(F.col("currency_key") != UNKNOWN_KEY)
    df = lookup(cart_items.select(*CART_COLUMNS), known_currency.select("currency_code", "currency_key"), "currency_code")
    df = lookup(df, distinct_rates(currency_rates), "currency_code")
    df = lookup(df, store.select("store_id", "store_key"), "store_id")
    df = lookup(df, products.select("product_id", "product_key"), "product_id")
    df = lookup(df, location.select("ip_address", "location_key"), "ip", table_key="ip_address")
    return df.select(
        joined_key(F.col("order_id"), F.col("product_id"), F.col("item_index")).alias("detail_key"),
        joined_key(F.col("order_id"), F.col("product_id")).alias("order_product_key"),
        *[or_unknown(k).alias(k) for k in
          ("customer_key", "product_key", "location_key", "currency_key", "store_key")],
        "order_id",
        date_key("order_date").alias("date_key"),
        "local_time",
        F.col("event_timestamp").alias("timestamp"),
        "ip",
        F.coalesce("amount", F.lit(0)).cast("bigint").alias("sales_amount"),
        F.coalesce("unit_price", F.lit(0.0)).cast("decimal(38,9)").alias("sales_local_price"),
        usd_price("unit_price", "rate_to_usd").alias("sales_usd_price"),
        *audit_columns(),
    )
