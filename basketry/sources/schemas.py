"""Declared input schemas and output contracts.

Identifier columns are always text on the way in; inference would turn some of them
into numbers and break later joins.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Event columns in the order of the raw table.
_EVENT_TEXT_HEAD = ["ip", "user_agent", "resolution", "user_id_db", "device_id", "api_version",
                    "store_id", "local_time", "show_recommendation", "current_url",
                    "referrer_url", "email_address"]
_EVENT_TEXT_MID = ["utm_source", "utm_medium", "collection", "product_id", "viewing_product_id"]
_EVENT_JSON = ["option", "cart_products"]
_EVENT_TEXT_TAIL = ["order_id", "currency", "price", "is_paypal", "cat_id", "collect_id",
                    "key_search", "recommendation_product_id",
                    "recommendation_product_position", "recommendation_clicked_position"]

# Product columns.
PRODUCT_COLUMNS = ["product_id", "source_url", "domain_used", "name", "sku", "attribute_set",
                   "type_id", "price", "min_price", "max_price", "min_price_format",
                   "max_price_format", "gold_weight", "collection", "collection_id",
                   "product_type", "category", "category_name", "store_code", "gender", "massiv"]

IP_LOCATION_COLUMNS = ["ip", "country_code", "country_name", "region_name", "city_name"]


def _texts(names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def event_schema(option_type: T.DataType | None = None) -> T.StructType:
    """Raw events.  JSON columns arrive as JSON text unless told otherwise."""
    json_fields = _texts(_EVENT_JSON)
    if option_type is not None:
        json_fields[0] = T.StructField("option", option_type)
    return T.StructType(
        [T.StructField("_id", T.StringType()), T.StructField("time_stamp", T.LongType())]
        + _texts(_EVENT_TEXT_HEAD)
        + [T.StructField("recommendation", T.BooleanType())]
        + _texts(_EVENT_TEXT_MID) + json_fields + _texts(_EVENT_TEXT_TAIL)
    )


EVENTS = event_schema()
PRODUCTS = T.StructType(_texts(PRODUCT_COLUMNS))
IP_LOCATIONS = T.StructType(_texts(["_id"] + IP_LOCATION_COLUMNS))
CURRENCY_RATES = T.StructType(
    _texts(["currency_symbol", "currency_code", "currency_name"])
    + [T.StructField("rate_to_usd", T.DoubleType())]
)
PRODUCT_URLS = T.StructType(_texts(["product_id", "url"]))
IP_RANGES = T.StructType(
    [T.StructField("ip_from", T.LongType()), T.StructField("ip_to", T.LongType())]
    + _texts(IP_LOCATION_COLUMNS[1:])
)

_AUDIT = "inserted_date timestamp, inserted_by string, updated_date timestamp, updated_by string"

# Output contracts: column order and types of every table of the warehouse.
CONTRACTS: dict[str, str] = {
    "dim_date": (
        "date_key bigint, full_date date, day_of_week bigint, day_name string, "
        "day_of_month bigint, day_of_year bigint, week_of_year bigint, month_number bigint, "
        "month_name string, quarter_number bigint, year_number bigint, is_weekend boolean, "
        + _AUDIT
    ),
    "dim_customer": (
        "customer_key bigint, customer_user_agent string, customer_user_id_db string, "
        "customer_device_id string, customer_email_address string, start_date date, "
        "end_date date, is_current boolean, " + _AUDIT
    ),
    "dim_product": (
        "product_key bigint, product_id bigint, product_name string, product_sku string, "
        "product_gender string, product_base_price decimal(38,9), "
        "product_min_price decimal(38,9), product_max_price decimal(38,9), " + _AUDIT
    ),
    "dim_location": (
        "location_key bigint, location_city_name string, location_region_name string, "
        "location_country_name string, location_country_code string, " + _AUDIT
    ),
    "dim_currency": (
        "currency_key bigint, currency_code string, currency_name string, " + _AUDIT
    ),
    "dim_store": "store_key bigint, store_id bigint, store_domain string, " + _AUDIT,
    "fact_exchange_rate": (
        "exchange_rate_key bigint, date_key bigint, currency_key bigint, "
        "rate_to_usd decimal(38,9)"
    ),
    "fact_sales_order_detail": (
        "detail_key bigint, order_product_key bigint, customer_key bigint, product_key bigint, "
        "location_key bigint, currency_key bigint, store_key bigint, order_id bigint, "
        "date_key bigint, local_time string, timestamp timestamp, ip string, "
        "sales_amount bigint, sales_local_price decimal(38,9), "
        "sales_usd_price decimal(38,9), " + _AUDIT
    ),
    "mart_sales_order_detail": (
        "detail_key bigint, order_id bigint, order_timestamp timestamp, full_date date, "
        "year_number bigint, quarter_number bigint, month_number bigint, month_name string, "
        "day_name string, is_weekend boolean, product_id bigint, product_name string, "
        "product_sku string, product_gender string, location_city_name string, "
        "location_region_name string, location_country_name string, "
        "location_country_code string, store_domain string, currency_code string, "
        "customer_key bigint, sales_amount bigint, sales_local_price double, "
        "sales_usd_price double, total_revenue_usd double"
    ),
}


def contract(name: str) -> T.StructType:
    return T.StructType.fromDDL(CONTRACTS[name])

# Columns that are profiled in each raw table.
PROFILE_FIELDS = {
    "raw_summary": ["ip", "product_id", "viewing_product_id", "current_url", "referrer_url", "collection",
                    "email_address", "time_stamp", "user_id_db", "device_id"],
    "raw_ip_location": ["ip", "country_name", "city_name"],
    "raw_products": ["product_id", "name", "sku", "price", "category", "gender"],
}
