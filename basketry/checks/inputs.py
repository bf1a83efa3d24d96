"""The shop's raw inputs, derived from the benchmark tables.

This is the only place that knows those tables.  Every derivation is row by row (plus
one join), so no order, customer or product gathers in one task.
"""

from __future__ import annotations

import json
from copy import copy
from functools import cached_property
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.functions.dates import epoch_seconds
from basketry.plans import catalog, staging, warehouse
from basketry.sources import schemas
from basketry.sources.readers import Registry, bundled_currency_rates, bundled_rate_rows

ROWS_A_PIECE = 250_000
UNMAPPED_SYMBOL = "¤?"
GENDER_SAMPLES = ["Women", " female ", "MEN", "Kids", "çocuk", "женски", "male", "", None,
                  "Kadın", "unisex"]
BROWSE_TYPES = {
    "view": "view_product_detail",
    "click": "select_product_option",
    "signup": "view_listing_page",
    "purchase": "add_to_cart_action",
    "error": "product_view_all_recommend_clicked",
}


def _ip(key: str) -> str:
    return (
        f"concat_ws('.', '10', cast({key} % 25 as string), "
        f"cast(({key} div 256) % 256 as string), cast({key} % 256 as string))"
    )


def _pick(values: list, index: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.expr(index).cast("int"))


def _member(name: str, value: str | None) -> str:
    """A member of a JSON object and the comma behind it; nothing for null, as `to_json` writes it."""
    return "" if value is None else f"{json.dumps(name)}:{json.dumps(value, ensure_ascii=False)},"


def _cart_text(product_first: Column, product: Column, amount: Column, price: Column, currency: Column) -> Column:
    """JSON text of a cart with an item and an entry without a product, before or behind it.

    What `to_json` writes for these structs, put together from texts: numbers and prices need
    no escapes, and ``currency`` is a member that `_member` has escaped.
    """
    def member(name: str, value: Column, quote: str = "") -> Column:
        return F.coalesce(F.concat(F.lit(f'"{name}":{quote}'), value.cast("string"), F.lit(f"{quote},")), F.lit(""))

    no_product = '{"amount":1,"price":"5.00","currency":"€"}'
    item = [member("product_id", product), member("amount", amount), member("price", price, '"'), F.coalesce(currency, F.lit("")),
            F.lit('"option":[{"option_id":7,"option_label":"a \\"quoted\\" {label}"}]}')]
    return F.concat(F.when(product_first, "[{").otherwise(f"[{no_product},{{"), *item,
                    F.when(product_first, f",{no_product}]").otherwise("]"))


def _events(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*[
        columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schemas.EVENTS.fields
    ])


class Inputs:
    """Lazy access to the benchmark tables below one folder and what derives from them."""

    _known: WeakKeyDictionary[SparkSession, dict[str, Inputs]] = WeakKeyDictionary()

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Inputs:
        """Inputs whose plans are built once a session; models are new each time."""
        known = cls._known.setdefault(spark, {})
        if folder not in known:
            known[folder] = cls(spark, folder)
        plans = known[folder]
        for name in ("rates", "checkouts", "browsing", "products", "ip_locations", "ip_ranges"):
            getattr(plans, name)
        return copy(plans)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, df: DataFrame, *keys: str) -> DataFrame:
        """Share out a table by its keys."""
        return df.repartition(self.pieces(df), *keys)

    def pieces(self, df: DataFrame) -> int:
        """As many pieces as any other shuffle has, or more of bounded size; a table's rows are counted from file footers."""
        return max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_A_PIECE))

    @cached_property
    def rates(self) -> DataFrame:
        return bundled_currency_rates(self.spark)

    @cached_property
    def line_items(self) -> DataFrame:
        columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
        # By the key of the join with orders, which then needs no second shuffle of the lines.
        return self.spread(self.table("lineitem").select(*columns), "l_orderkey")

    @cached_property
    def tracked_lines(self) -> DataFrame:
        """The line items with what their checkout events need of the order, once for each event."""
        x = F.expr
        # What follows from the day is made once an order, not once a line.
        orders = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderpriority", epoch_seconds("o_orderdate").alias("o_seconds"),
            F.col("o_orderdate").cast("string").alias("o_local_time"))
        lines = self.line_items
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
            "copy", x("explode(if(l_orderkey % 17 = 0, array(0, 1), array(0)))")
        )

    @cached_property
    def checkouts(self) -> DataFrame:
        """A checkout event per line item; orders divisible by 17 are tracked twice."""
        return self._checkouts_of(self.tracked_lines)

    def scrambled_checkouts(self) -> DataFrame:
        """The checkout events dealt into pieces by their id, so that none holds an order's events together.

        What is dealt are the columns the id is made of and a few more; an event is many times as wide.
        """
        of_id = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "copy"]
        return self._checkouts_of(self.tracked_lines.repartition(self.pieces(self.table("lineitem")), *of_id))

    def _checkouts_of(self, df: DataFrame) -> DataFrame:
        x = F.expr
        seconds = x("o_seconds + (l_linenumber * 10 + copy * 60)")
        us_price = x(
            "if(l_suppkey % 7 = 0, format_number(floor(l_extendedprice), 0), "
            "format_number(l_extendedprice, 2))"
        )
        price = F.when(x("l_linenumber % 2 = 1"), us_price).otherwise(F.translate(us_price, ",.", ".,"))
        symbols = [r[0] for r in bundled_rate_rows()] + [UNMAPPED_SYMBOL, None]
        empty = F.lit(None)
        cart = _cart_text(
            x("l_linenumber % 2 = 1"), F.col("l_partkey"), F.col("l_quantity").cast("int"), price,
            _pick([_member("currency", s) for s in symbols], f"l_suppkey % {len(symbols)}"))
        shop = x("cast(o_custkey % 25 as string)")
        key = x("cast(l_orderkey as string)")
        return _events(df, {
            "_id": x("concat_ws('-', 'e', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                     "cast(round(l_extendedprice * 100) as bigint), copy)"),
            "time_stamp": seconds,
            "ip": x(f"if(o_custkey % 97 = 0, '   ', {_ip('o_custkey')})"),
            "user_agent": F.col("o_orderpriority"),
            "user_id_db": x("if(o_custkey % 50 = 0, '', if(o_custkey % 2 = 1, "
                            "concat('\\t', o_custkey, ' '), cast(o_custkey as string)))"),
            "device_id": x("concat('dev-', l_orderkey % 997)"),
            "store_id": F.when(x("o_custkey % 83 = 0"), "").when(
                x("l_orderkey % 2 = 1"), F.concat(F.lit(" "), shop)).otherwise(shop),
            "local_time": F.col("o_local_time"),
            "current_url": F.when(x("l_orderkey % 13 = 0"), empty.cast("string"))
                .when(x("l_orderkey % 10 = 0"),
                      F.concat(F.lit("https://m.shop"), shop, F.lit(".example.net:8443/checkout")))
                .otherwise(F.concat(F.lit("https://shop"), shop,
                                    F.lit(".example.com/checkout/success?o="), key)),
            "email_address": x("if(o_custkey % 11 = 0, null, concat(' User', o_custkey, '@Example.COM '))"),
            "collection": F.lit("checkout_success"),
            "cart_products": F.when(x("l_partkey % 500 = 0"), '{"product_id":1}').otherwise(cart),
            "order_id": F.when(x("l_orderkey % 101 = 0"), F.concat(F.lit("x"), key))
                .otherwise(F.concat(key, F.lit(".0"))),
        })

    @cached_property
    def order_carts(self) -> DataFrame:
        """A checkout event per order, tracked twice for those divisible by 17, with all its items.

        A product may occur in several items.  Orders have few line items in these tables.
        """
        x = F.expr
        line = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
        carts = self.table("lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
        symbols = F.array(*[F.lit(r[0]) for r in bundled_rate_rows()], F.lit(UNMAPPED_SYMBOL), F.lit(None))
        items = F.transform("lines", lambda one: F.struct(
            (one["l_partkey"] % 40).alias("product_id"),
            one["l_quantity"].cast("int").alias("amount"),
            F.format_number(one["l_extendedprice"], 2).alias("price"),
            F.get(symbols, (one["l_suppkey"] % F.size(symbols)).cast("int")).alias("currency"),
        ))
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        df = carts.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn(
            "copy", x("explode(if(l_orderkey % 17 = 0, array(0, 1), array(0)))"))
        text = F.col("l_orderkey").cast("string")
        return _events(df, {
            "_id": F.concat_ws("-", F.lit("c"), "l_orderkey", "copy"),
            "time_stamp": epoch_seconds("o_orderdate") + F.col("copy") * 60,
            "collection": F.lit("checkout_success"),
            "order_id": F.when(x("l_orderkey % 101 = 0"), F.concat(F.lit("x"), text)).otherwise(F.concat(text, F.lit(".0"))),
            "cart_products": F.to_json(items),
        })

    @cached_property
    def browsing(self) -> DataFrame:
        """Browse events, one per row of ``events``."""
        x = F.expr
        df = self.table("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        kind = F.lit(None).cast("string")
        for source, name in BROWSE_TYPES.items():
            kind = F.when(F.col("event_type") == source, name).otherwise(kind)
        shop = x("cast(user_id % 25 as string)")
        is_error = F.col("event_type") == "error"
        viewed = x("if(k % 10 = 1, '', cast(event_id % 400 as string))")
        return _events(df, {
            "_id": x("concat('b', event_id)"),
            "time_stamp": epoch_seconds("ts"),
            "ip": x(f"if(user_id % 29 = 0, null, {_ip('(user_id * 7)')})"),
            "user_id_db": x("cast(user_id as string)"),
            "local_time": F.col("ts").cast("string"),
            "current_url": F.when(x("k % 25 <> 3"), F.concat(
                F.lit("https://shop"), shop, F.lit(".example.com/p/"), x("cast(event_id as string)"))),
            "referrer_url": F.when(is_error, F.concat(
                F.lit("https://m.shop"), shop, F.lit(".example.net/r/"), x("cast(event_id as string)"))),
            "recommendation": x("k % 2 = 0"),
            "utm_source": F.when(x("k % 5 = 0"), "feed"),
            "collection": kind,
            "product_id": F.when(~is_error, F.when(x("k % 10 <> 0"), x(
                "if(k % 10 = 1, '', cast(event_id % 300 as string))"))),
            "viewing_product_id": F.when(is_error | x("k % 10 = 0"), viewed),
            "option": x("if(k % 2 = 0, concat('[{\"option_label\":\"alloy\",\"value_id\":', k, '}]'), "
                        "concat('{\"alloy\":\"gold\",\"k\":', k, '}'))"),
        })

    @cached_property
    def events(self) -> DataFrame:
        """The raw event table."""
        return self.checkouts.unionByName(self.browsing)

    @cached_property
    def products(self) -> DataFrame:
        """The raw product table."""
        x = F.expr
        price = x("cast(p_retailprice as string)")
        columns = {
            "product_id": x("if(p_partkey % 211 = 0, null, cast(p_partkey as string))"),
            "name": x("if(p_partkey % 53 = 0, '  ', concat(' ', p_name, '\\t'))"),
            "sku": F.col("p_brand"),
            "price": price,
            "min_price": x("if(p_partkey % 9 = 0, 'n/a', cast(p_retailprice as string))"),
            "max_price": F.when(x("p_partkey % 4 <> 0"), price),
            "category": F.col("p_type"),
            "gender": _pick(GENDER_SAMPLES, f"p_size % {len(GENDER_SAMPLES)}"),
        }
        return self.table("part").select(*[
            columns.get(c, F.lit(None)).cast("string").alias(c) for c in schemas.PRODUCT_COLUMNS
        ])

    @property
    def _places(self) -> DataFrame:
        region = self.table("region").select("r_regionkey", F.lower("r_name").alias("region"))
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        df = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        x = F.expr
        return df.select(
            F.col("n_nationkey").cast("bigint").alias("n"),
            x("case n_nationkey when 3 then '-' when 4 then 'usa' "
              "else concat(' x', char(97 + n_nationkey), ' ') end").alias("country_code"),
            x("case n_nationkey when 3 then '-' when 6 then 'INVALID IP ADDRESS' "
              "else lower(n_name) end").alias("country_name"),
            x("case n_nationkey when 3 then '-' when 6 then '  ' else region end").alias("region_name"),
            x("case n_nationkey when 3 then '-' when 5 then 'IPV6 address missing in bin' "
              "else concat('saint-', region, ' ', n_nationkey) end").alias("city_name"),
        )

    @cached_property
    def ip_locations(self) -> DataFrame:
        """The raw location table: two of three customers' addresses, some of them twice."""
        x = F.expr
        customers = self.table("customer").where("c_custkey % 3 <> 0 and c_custkey % 97 <> 0")
        df = customers.select("c_custkey", x("c_custkey % 25").alias("n")).join(self._places, "n")
        # Cleaning places is costly: neither a file of few row groups nor a join that broadcasts the
        # customers to the places may leave it to as few tasks.
        df = df.repartition(self.pieces(self.table("customer")), "c_custkey")
        df = df.withColumn("copy", x("explode(if(c_custkey % 20 = 0, array(0, 1), array(0)))"))
        return df.select(
            x("concat('l', c_custkey, '-', copy)").alias("_id"),
            x(f"concat(if(c_custkey % 11 = 0, ' ', ''), {_ip('c_custkey')})").alias("ip"),
            "country_code", "country_name", "region_name",
            x("if(copy = 1, 'zz alternative', city_name)").alias("city_name"),
        )

    @cached_property
    def ip_ranges(self) -> DataFrame:
        """Address ranges: a /16 per nation, two halves for nation 7, none for nation 8."""
        x = F.expr
        halves = self._places.where("n <> 8").withColumn(
            "half", x("explode(if(n = 7, array(0, 1), array(0)))")
        )
        start = x("(10 * 256 + n) * 65536 + half * 32768")
        return halves.select(
            start.alias("ip_from"),
            (start + x("if(n = 7, 32768, 65536)") - 1).alias("ip_to"),
            "country_code", "country_name", "region_name",
            x("if(half = 1, 'second half', city_name)").alias("city_name"),
        )

    @cached_property
    def product_pages(self) -> DataFrame:
        """Stored pages with a product object embedded; page_id % 8 decides what is wrong."""
        x = F.expr
        text_id = x("cast(page_id as string)")
        name = F.when(x("page_id % 8 <> 3"), F.concat(F.lit('Ring {"'), text_id, F.lit('\\"} x')))
        product = F.to_json(F.struct(
            F.when(x("page_id % 3 > 0"), x("1000 + page_id")).alias("product_id"),
            name.alias("name"),
            x("concat('SKU-', page_id)").alias("sku"),
            x("cast(page_id * 1.5 as double)").alias("price"),
            F.struct(
                F.struct(x("if(page_id % 2 = 0, 'women', 'men')").alias("value")).alias("gender"),
                F.struct(x("cast(page_id % 4 as string)").alias("value")).alias("massiv"),
            ).alias("attributes"),
            F.when(x("page_id % 5 = 0"), "kids").when(x("page_id % 5 = 1"), "").alias("gender"),
        ))
        # Keys that occur twice: the last one counts.
        earlier = F.when(x("page_id % 8 <> 3"), '{"name":"old",').otherwise("{")
        product = F.concat(earlier, F.lit('"sku":"old","attributes":{"gender":{"value":"old"}},'), F.substr(product, F.lit(2)))
        script = x("page_id % 8")
        embedded = (
            F.when(script == 0, F.lit(""))
            .when(script == 1, F.concat(F.lit("var react_data = "), F.substring(product, 1, 20)))
            .when(script == 2, F.lit("var react_data = {'name': 1};"))
            .when(script == 4, F.lit("var react_data = {};"))
            .otherwise(F.concat(F.lit("var react_data = "), product, F.lit("; var other = {\"q\": 2};")))
        )
        extra = F.when(script == 5, "<p>Access Denied</p>").when(script == 6, "<p>Page NOT found</p>").otherwise("")
        return self.table("pages").select(
            "page_id",
            x("cast(page_id div 2 as string)").alias("product_id"),
            x("concat('shop', page_id % 25, '.example.com')").alias("domain"),
            x("cast(page_id % 2 as int)").alias("attempt"),
            F.concat("html", extra, embedded).alias("html"),
        )

    @cached_property
    def url_list(self) -> DataFrame:
        """(product_id, url, page_id) from the page table; 200 products share its URLs."""
        return self.table("pages").select(
            F.expr("cast(page_id % 200 as string)").alias("product_id"), "url", "page_id"
        )

    @cached_property
    def crawl_plan(self) -> DataFrame:
        """Domain plan of products that have five of the stored pages each."""
        urls = self.product_pages.select(
            F.expr("cast(page_id div 5 as string)").alias("product_id"),
            F.concat(F.lit("https://"), "domain", F.lit("/p/"), "page_id").alias("url"), "page_id")
        return catalog.domain_plan(urls, ["page_id"])

    def crawled(self, plan: DataFrame) -> DataFrame:
        """(product_id, domain, html, page_id): a page for most of the planned attempts."""
        x = F.expr
        found = self.product_pages.where("page_id % 9 <> 4").select(
            x("cast(page_id div 5 as string)").alias("product_id"),
            x("cast((page_id + page_id div 5) % 5 as int)").alias("place"), "html", "page_id")
        return found.join(plan.select("product_id", "attempts"), "product_id").select(
            "product_id", F.get("attempts", F.col("place")).alias("domain"), "html", "page_id")

    @cached_property
    def documents(self) -> DataFrame:
        """(event_id, collection, document): events as JSON documents with nested fields."""
        x = F.expr
        df = self.table("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        document = F.to_json(F.struct(
            F.col("event_id").alias("_id"),
            F.col("event_type").alias("collection"),
            F.when(x("k % 2 = 0"), F.col("value")).alias("value"),
            F.from_json("props", "struct<k: int>").alias("props"),
            x("array(struct(k % 3 = 0 as flag, if(k % 3 = 0, array(1, 2), null) as sizes))").alias("items"),
        ), {"ignoreNullFields": "false"})
        return df.select("event_id", F.col("event_type").alias("collection"), document.alias("document"))

    # ---- models built from the inputs, shared by the queries on top of them ----

    @cached_property
    def cart(self) -> DataFrame:
        return staging.checkout_cart_items(self.events, self.rates)

    @cached_property
    def models(self) -> Registry:
        return warehouse.define(self.spark, self.events, self.ip_locations, self.products, self.rates)

    @cached_property
    def models_of_one_use(self) -> Registry:
        """The models, for queries in which the cart items feed one of them."""
        return warehouse.define(self.spark, self.events, self.ip_locations, self.products, self.rates, write_cart=False)

    @property
    def fact(self) -> DataFrame:
        return self.models[warehouse.FACT]

    @property
    def mart(self) -> DataFrame:
        return self.models[warehouse.FLAT]
