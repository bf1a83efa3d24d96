"""Staging models: raw rows cleaned and typed, nothing aggregated away but duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField

from basketry.functions import business, jsontext
from basketry.functions.dates import utc_date
from basketry.functions.keys import surrogate_key
from basketry.functions.numbers import float_text_to_long, parse_price, to_long, to_numeric
from basketry.functions.text import blank_to_null, url_host
from basketry.operators.lookup import lookup
from basketry.operators.pick import first_per_key

CHECKOUT = "checkout_success"
ITEM_FIELDS = ["product_id", "amount", "price", "currency"]
ITEMS = "items"
CLEANED = ["ip", "store_id", "user_id_db", "email_address", "device_id", "user_agent"]


def parsed_carts(events: DataFrame) -> DataFrame:
    """Checkout events with the items of their carts, each cart parsed once.

    What several models need can be written and given to them instead of the raw events:
    carts that are parsed already stay as they are.
    """
    if ITEMS in events.columns:
        return events
    host = F.coalesce(url_host("current_url"), F.when(F.col("current_url").isNotNull(), ""))
    return events.where(F.col("collection") == CHECKOUT).select(
        "_id", "time_stamp", "local_time", "order_id", *CLEANED, host.alias("host"),
        jsontext.items_fields("cart_products", ITEM_FIELDS).alias(ITEMS))


def cart_lines(events: DataFrame) -> DataFrame:
    """One row per product in the cart of a checkout event, fields still as text."""
    # From a generator that drops rows Spark infers a filter on the items and moves it down to the
    # scan: every cart would be parsed there, and once more here.  An empty cart gives no product.
    lines = parsed_carts(events).where(F.col("time_stamp").isNotNull()).select(
        F.col("_id").alias("source_event_id"), "time_stamp", "local_time", "order_id",
        *CLEANED, F.posexplode_outer(ITEMS).alias("item_index", "item"),
    ).where(F.col("item.product_id").isNotNull())
    return lines.select(
        "source_event_id", "time_stamp", "local_time", "order_id",
        *[blank_to_null(c).alias(c) for c in CLEANED], "item_index",
        *[F.col(f"item.{f}").alias(f"item_{f}") for f in ITEM_FIELDS],
    )


def with_currency_code(lines: DataFrame, currency: DataFrame) -> DataFrame:
    """Code of each line's symbol.  A symbol without a rate gets 'UNK', no symbol gets null.

    Reading the seed instead of the currency model saves a second pass over all carts:
    the model holds every symbol that occurs, so both give the same code.
    """
    codes = currency.select("currency_symbol", F.col("currency_code").alias("known_code"))
    code = F.when(
        F.col("currency_symbol").isNotNull(),
        F.coalesce("known_code", F.lit(business.UNKNOWN_CODE)),
    )
    return (
        lookup(lines, codes, "currency_symbol")
        .withColumn("currency_code", code).drop("currency_symbol", "known_code")
    )


LINE_KEY = ["order_id", "product_id"]
LINE_ORDER = [*LINE_KEY, "time_stamp", "source_event_id", "item_index"]


def _keyed_lines(events: DataFrame) -> DataFrame:
    """All lines with the ids that tell them apart; the rest still as text."""
    lines = cart_lines(events)
    return (lines.withColumn("order_id", float_text_to_long("order_id"))
                 .withColumn("product_id", to_long("item_product_id")).drop("item_product_id"))


def _typed(keyed: DataFrame, currency_rates: DataFrame, *others: str) -> DataFrame:
    typed = keyed.select(
        *others,
        "source_event_id",
        F.col("item_index").cast("bigint").alias("item_index"),
        "time_stamp",
        F.timestamp_seconds("time_stamp").alias("event_timestamp"),
        utc_date("time_stamp").alias("order_date"),
        "local_time", "ip", "store_id", "user_id_db",
        surrogate_key("user_id_db").alias("customer_key"),
        "email_address", "device_id", "user_agent",
        "order_id", "product_id",
        to_long("item_amount").alias("amount"),
        parse_price("item_price").alias("unit_price"),
        F.nullif(F.col("item_currency"), F.lit("")).alias("currency_symbol"),
    )
    return with_currency_code(typed, currency_rates)


def typed_lines(events: DataFrame, currency_rates: DataFrame) -> DataFrame:
    """All lines of successful checkouts, typed and with their currency's code."""
    return _typed(_keyed_lines(events), currency_rates)


def _as_text(columns: list[str]) -> Column:
    """A row's values as one JSON array: in a shuffle or a state a fraction of a row with as many
    columns, each of which takes a word for its place and fills up its last one."""
    return F.to_json(F.array(*[F.col(c).cast("string") for c in columns]))


def _from_text(packed: DataFrame, fields: list[StructField]) -> DataFrame:
    """The fields of the text ``line``, and the other columns beside them."""
    beside = [c for c in packed.columns if c != "line"]
    values = packed.select(*beside, F.from_json("line", "array<string>").alias("__line"))
    return values.select(*beside, *[F.get("__line", F.lit(n)).cast(f.dataType).alias(f.name) for n, f in enumerate(fields)])


def packed_lines(events: DataFrame) -> DataFrame:
    """All lines with the columns that order them, and each whole line as one text, ``line``."""
    keyed = _keyed_lines(events)
    return keyed.select(*LINE_ORDER, _as_text(keyed.columns).alias("line"))


def unpacked_lines(packed: DataFrame, events: DataFrame, currency_rates: DataFrame) -> DataFrame:
    """Typed lines from the texts of ``packed_lines``; other columns of ``packed`` stay beside them."""
    lines = _from_text(packed, _keyed_lines(events).schema.fields)
    return _typed(lines, currency_rates, *[c for c in packed.columns if c != "line"])


def checkout_cart_items(events: DataFrame, currency_rates: DataFrame, *, whole: bool = False) -> DataFrame:
    """Distinct (order, product) lines of successful checkouts; of repeated tracking events
    the earliest stays.

    For whoever keeps ``whole`` lines they are shuffled as texts; others get the columns they need.
    """
    keyed = _keyed_lines(events)
    others = [f for f in keyed.schema if f.name not in LINE_ORDER]
    first = first_per_key(
        keyed.select(*LINE_ORDER, _as_text([f.name for f in others]).alias("line")) if whole else keyed, LINE_KEY,
        [F.asc("time_stamp"), F.asc("source_event_id"), F.asc("item_index")],
    )
    # Only lines that stay are typed, and columns that follow from others are not shuffled.
    return _typed(_from_text(first, others) if whole else first, currency_rates)


def currency_symbols(events: DataFrame, *by: Column) -> DataFrame:
    """Distinct currency symbols of all carts, for each value of ``by`` if given."""
    items = parsed_carts(events).select(*by, F.explode(F.col(f"{ITEMS}.currency")).alias("currency_symbol"))
    kept = [c for c in items.columns if c != "currency_symbol"]
    return items.select(
        *kept, F.nullif("currency_symbol", F.lit("")).alias("currency_symbol")
    ).distinct()


def currencies(symbols: DataFrame, currency_rates: DataFrame) -> DataFrame:
    """ISO code of every symbol."""
    seed = currency_rates.select(
        "currency_symbol", F.col("currency_code").alias("known_code"), "currency_name"
    )
    code = F.coalesce("known_code", F.lit(business.UNKNOWN_CODE))
    return lookup(symbols.select("currency_symbol").distinct(), seed, "currency_symbol").select(
        business.currency_key(code).alias("currency_key"),
        "currency_symbol", code.alias("currency_code"), "currency_name",
    )


def currency(events: DataFrame, currency_rates: DataFrame) -> DataFrame:
    """Every symbol that occurs in a cart, with its ISO code."""
    return currencies(currency_symbols(events), currency_rates)


def location(ip_locations: DataFrame) -> DataFrame:
    """One cleaned place per IP address."""
    cleaned = ip_locations.where(F.col("ip").isNotNull()).select(
        blank_to_null("ip").alias("ip_address"),
        business.country_code("country_code").alias("country_code"),
        *[business.place_name(c).alias(c) for c in ("country_name", "region_name", "city_name")],
    )
    one_each = first_per_key(
        cleaned, ["ip_address"],
        [F.asc(c) for c in ("country_code", "region_name", "city_name", "country_name")],
    )
    key = business.location_key("country_code", "region_name", "city_name")
    return one_each.select(key.alias("location_key"), "*")


def products(raw_products: DataFrame) -> DataFrame:
    """Typed products; an id that is not a number fails the run."""
    typed = raw_products.where(F.col("product_id").isNotNull()).select(
        F.col("product_id").cast("bigint").alias("product_id"),
        blank_to_null("name").alias("product_name"),
        blank_to_null("sku").alias("product_sku"),
        business.gender_group("gender").alias("product_gender"),
        to_numeric("price").alias("product_base_price"),
        to_numeric("min_price").alias("product_min_price"),
        to_numeric("max_price").alias("product_max_price"),
    )
    return typed.select(surrogate_key(F.col("product_id").cast("string")).alias("product_key"), "*")


def store_visits(events: DataFrame, *by: Column) -> DataFrame:
    """How often checkouts of a store come from a host, for each value of ``by`` if given."""
    visits = parsed_carts(events).where(
        F.col("store_id").isNotNull() & F.col("host").isNotNull()
    # Named apart from the raw column, or the grouping would bind to the untrimmed id.
    ).select(*by, blank_to_null("store_id").alias("store"), F.nullif("host", F.lit("")).alias("host"))
    return visits.groupBy(*visits.columns).agg(F.count(F.lit(1)).alias("cnt"))


def stores(visits: DataFrame) -> DataFrame:
    """Stores with their most frequent host."""
    summed = visits.groupBy("store", "host").agg(F.sum("cnt").alias("cnt"))
    top = first_per_key(summed, ["store"], [F.desc("cnt"), F.asc_nulls_last("host")])
    return top.select(
        surrogate_key("store").alias("store_key"),
        F.col("store").alias("store_id"), F.col("host").alias("store_domain"),
    )


def store(events: DataFrame) -> DataFrame:
    """Stores with the host their checkouts come from most often."""
    return stores(store_visits(events))
