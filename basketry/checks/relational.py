"""Projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from basketry.checks.oracle import query
from basketry.checks.registry import case
from basketry.functions import business, jsontext
from basketry.functions.dates import is_weekend
from basketry.functions.numbers import float_text_to_long, to_long
from basketry.functions.text import blank_to_null, contains_any, is_filled, url_host
from basketry.operators import discovery, iprange, lookup, pick, profile, quality
from basketry.plans import catalog, dims, facts, staging
from basketry.sources.readers import route_column

def cnt():
    return F.count(F.lit(1)).alias("cnt")


# ---- projections -------------------------------------------------------------------------

@case("prj1_select_rename", """
SELECT CASE WHEN p_partkey % 211 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS product_id,
       p_brand AS product_sku, p_type AS product_category FROM part""")
def _(i):
    return i.products.select(
        "product_id", F.col("sku").alias("product_sku"), F.col("category").alias("product_category"))


@case("prj2_all_but", query("""
SELECT country_code, country_name, region_name, city_name, ip_address FROM loc"""))
def _(i):
    return staging.location(i.ip_locations).drop("location_key")


@case("prj3_document_fields", query("SELECT ip, raw_code AS country_code, raw_region AS region_name FROM ipl"))
def _(i):
    return i.ip_locations.select("ip", "country_code", "region_name")


@case("prj4_fallback_field", query("""
SELECT _id, coalesce(product_id, viewing_product_id) AS pid FROM browse"""))
def _(i):
    return i.browsing.select("_id", F.coalesce("product_id", "viewing_product_id").alias("pid"))


@case("prj5_dat9_audit_columns", query("""
SELECT store_id, 'dbt' AS inserted_by, 'dbt' AS updated_by, true AS same_moment, true AS is_recent FROM dim_store"""))
def _(i):
    rows = dims.store(staging.store(i.events))
    age = F.current_timestamp().cast("bigint") - F.col("inserted_date").cast("bigint")
    return rows.select(
        "store_id", "inserted_by", "updated_by",
        (F.col("inserted_date") == F.col("updated_date")).alias("same_moment"),
        age.between(0, 3600).alias("is_recent"))


@case("prj6_typed_null", """
SELECT c_custkey, CAST(NULL AS DATE) AS end_date FROM customer""")
def _(i):
    return i.table("customer").select("c_custkey", F.lit(None).cast("date").alias("end_date"))


@case("prj7_contract_order", query("""
SELECT currency_key || '|' || currency_code || '|' || currency_name AS line FROM dim_cur"""))
def _(i):
    shuffled = dims.currency(staging.currency(i.events, i.rates)).select(
        "updated_by", "currency_name", "inserted_date", "currency_code", "updated_date",
        "inserted_by", "currency_key")
    ordered = quality.enforce_contract(shuffled, "dim_currency").drop(*dims.AUDIT)
    return ordered.select(F.concat_ws("|", *ordered.columns).alias("line"))


# ---- filters -----------------------------------------------------------------------------

@case("flt1_event_type", query("""
SELECT source_event_id AS _id, CASE WHEN order_id IS NULL THEN 'x' || l_orderkey ELSE l_orderkey || '.0' END AS order_id FROM ev"""))
def _(i):
    return i.events.where(F.col("collection") == staging.CHECKOUT).select("_id", "order_id")


@case("flt2_event_types", query("""
SELECT _id, collection FROM browse
WHERE collection IN ('view_product_detail', 'select_product_option', 'add_to_cart_action')"""))
def _(i):
    return i.events.where(F.col("collection").isin(catalog.PRODUCT_EVENTS)).select("_id", "collection")


@case("flt3_present", query("SELECT _id FROM browse WHERE current_url IS NOT NULL AND product_id IS NOT NULL"))
def _(i):
    return i.browsing.where(F.col("current_url").isNotNull() & F.col("product_id").isNotNull()).select("_id")


@case("flt4_flt5_filled", query("SELECT _id, product_id FROM browse WHERE product_id <> ''"))
def _(i):
    return i.browsing.where(is_filled("product_id")).select("_id", "product_id")


@case("flt6_unknown_range", query("""
SELECT DISTINCT ip, CASE WHEN n IS NULL OR n IN (3, 8) THEN '-' ELSE trim(raw_code) END AS kept,
       n NOT IN (3, 8) AS in_full_load
FROM (SELECT ip FROM ev UNION ALL SELECT ip FROM browse)
     LEFT JOIN place ON CAST(split_part(ip, '.', 2) AS INTEGER) = n WHERE ip IS NOT NULL"""))
def _(i):
    full = iprange.locate(i.events, i.ip_ranges, skip_unknown=True).select("ip", F.lit(True).alias("hit"))
    # Blank addresses are rejected by either load.
    kept = iprange.locate(i.events, i.ip_ranges, skip_unknown=False).where("error is null")
    return kept.join(full, "ip", "left").select(
        "ip", F.trim("country_code").alias("kept"), F.coalesce("hit", F.lit(False)).alias("in_full_load"))


@case("flt7_json_field_present", query("SELECT source_event_id, item_index FROM ev WHERE NOT broken_cart"))
def _(i):
    return staging.cart_lines(i.events).select(
        "source_event_id", F.col("item_index").cast("bigint").alias("item_index"))


@case("flt8_known_members", query("SELECT currency_key, currency_code FROM dim_cur WHERE currency_key <> -1"))
def _(i):
    return dims.currency(staging.currency(i.events, i.rates)).where(
        F.col("currency_key") != -1).select("currency_key", "currency_code")


@case("flt9_dat8_stm2_look_back", query("""
SELECT order_id, product_id, order_date FROM cart WHERE order_date >= DATE '2001-07-29' - 3"""))
def _(i):
    cart = i.cart
    return facts.recent(cart, datetime.date(2001, 7, 29)).select("order_id", "product_id", "order_date")


@case("flt10_str10_broken_names", query("""
SELECT ip FROM ipl WHERE raw_city LIKE '%INVALID%' OR upper(raw_city) LIKE '%MISSING%'"""))
def _(i):
    return i.ip_locations.where(contains_any("city_name", business.BROKEN_PLACE_WORDS)).select("ip")


@case("flt11_two_letter_code", query("""
SELECT ip, raw_code AS country_code FROM ipl WHERE regexp_matches(trim(raw_code), '^[a-z]{2}$')"""))
def _(i):
    return i.ip_locations.where(F.trim("country_code").rlike("^[a-z]{2}$")).select("ip", "country_code")


@case("flt12_path_routing", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'raw_summary' WHEN 1 THEN NULL WHEN 2 THEN NULL
                ELSE 'raw_products' END AS raw_table FROM pages""")
def _(i):
    folder = F.when(F.col("page_id") % 4 == 3, "raw/products/").when(
        F.col("page_id") % 4 == 1, "raw/other/").otherwise("raw/summary/")
    ending = F.when(F.col("page_id") % 4 == 2, ".pdf").otherwise(".jsonl")
    listed = i.table("pages").select(
        "page_id", F.concat(folder, F.col("page_id").cast("string"), ending).alias("path"))
    return listed.select("page_id", route_column("path").alias("raw_table"))


@case("flt13_weekend", "SELECT o_orderkey FROM orders WHERE dayofweek(o_orderdate) IN (0, 6)")
def _(i):
    return i.table("orders").where(is_weekend("o_orderdate")).select("o_orderkey")


@case("flt14_agg15_dq13_duplicate_groups", query("""
SELECT order_id, product_id, count(*) AS cnt FROM item GROUP BY ALL HAVING count(*) > 1"""))
def _(i):
    lines = staging.cart_lines(i.events).select(
        float_text_to_long("order_id").alias("order_id"), to_long("item_product_id").alias("product_id"))
    return quality.duplicate_keys(lines, ["order_id", "product_id"])


@case("flt15_page_problem", query("""
SELECT page_id, CASE WHEN page_length < 1000 THEN 'empty_or_too_short'
       WHEN native_denied OR v = 5 THEN 'access_denied' WHEN native_404 OR v = 6 THEN '404_not_found' END AS problem
FROM stored"""))
def _(i):
    return i.product_pages.select("page_id", business.page_problem("html").alias("problem"))


# ---- joins -------------------------------------------------------------------------------

@case("jon1_symbol_lookup", query("""
SELECT source_event_id, currency_code FROM item"""))
def _(i):
    lines = staging.cart_lines(i.events).select(
        "source_event_id", F.nullif(F.col("item_currency"), F.lit("")).alias("currency_symbol"))
    return staging.with_currency_code(lines, i.rates)


@case("jon2_symbols_to_seed", query("SELECT currency_symbol, currency_code, currency_name FROM cur"))
def _(i):
    return staging.currency(i.events, i.rates).select("currency_symbol", "currency_code", "currency_name")


@case("jon3_star_lookup", query("""
SELECT location_key, currency_key, store_key, product_key, count(*) AS cnt FROM fact GROUP BY ALL"""))
def _(i):
    return i.fact.groupBy("location_key", "currency_key", "store_key", "product_key").agg(cnt())


@case("jon4_mart_lookup", query("""
SELECT store_domain, currency_code, product_gender, location_country_code, year_number, count(*) AS cnt
FROM mart GROUP BY ALL"""))
def _(i):
    return i.mart.groupBy(
        "store_domain", "currency_code", "product_gender", "location_country_code", "year_number").agg(cnt())


@case("jon5_every_pair", query("""
SELECT date_key, currency_code FROM dim_date, (SELECT currency_code FROM dim_cur WHERE currency_key <> -1)"""))
def _(i):
    models = i.models_of_one_use
    cart = models["stg_checkout_success_cart_items"]
    codes = dims.currency(models["stg_currency"]).where("currency_key <> -1").select("currency_code")
    return lookup.every_pair(dims.date(cart).select("date_key"), codes)


@case("jon6_inner_rates", query("""
SELECT d.currency_key, d.currency_code, rate_to_usd FROM dim_cur d JOIN rate ON rate.currency_code = d.currency_code"""))
def _(i):
    codes = dims.currency(staging.currency(i.events, i.rates)).select("currency_key", "currency_code")
    return codes.join(facts.distinct_rates(i.rates), "currency_code")


@case("jon7_missing_addresses", query("""
SELECT coalesce(ip, '   ') AS ip FROM ev UNION SELECT ip FROM browse WHERE ip IS NOT NULL
EXCEPT SELECT ip FROM ipl"""))
def _(i):
    return lookup.missing_keys(i.events, i.ip_locations, "ip")


@case("jon8_rows_with_keys", query("""
SELECT ip, raw_city AS city_name FROM ipl
WHERE ip IN (SELECT ip FROM ev UNION ALL SELECT ip FROM browse)"""))
def _(i):
    return lookup.rows_with_keys(i.ip_locations, i.events, "ip").select("ip", "city_name")


@case("jon9_stm4_remaining_tasks", """
SELECT CAST(page_id % 200 AS VARCHAR) AS product_id, url FROM pages WHERE page_id % 200 NOT IN (
  SELECT page_id % 200 FROM pages WHERE page_id % 3 = 0)""")
def _(i):
    done = i.url_list.where("page_id % 3 = 0")
    return catalog.open_tasks(i.url_list, done).select("product_id", "url")


@case("jon10_set4_first_source_wins", query("""
SELECT DISTINCT product_id AS k, 'direct' AS source FROM browse WHERE product_id <> ''
UNION ALL
SELECT DISTINCT viewing_product_id, 'viewed' FROM browse WHERE viewing_product_id <> ''
  AND viewing_product_id NOT IN (SELECT product_id FROM browse WHERE product_id <> '')"""))
def _(i):
    def keys(column, source):
        return i.browsing.where(is_filled(column)).select(F.col(column).alias("k")).distinct().withColumn(
            "source", F.lit(source))

    return lookup.first_source_wins(keys("product_id", "direct"), keys("viewing_product_id", "viewed"), "k")


@case("jon10_set4_best_source", query("""
SELECT k, arg_min(source, rank) AS source, arg_min(seen, rank) AS seen FROM (
  SELECT product_id AS k, 'direct' AS source, min(time_stamp) AS seen, 1 AS rank FROM browse WHERE product_id <> '' GROUP BY ALL
  UNION ALL SELECT viewing_product_id, 'viewed', min(time_stamp), 2 FROM browse WHERE viewing_product_id <> '' GROUP BY ALL)
GROUP BY k"""))
def _(i):
    def keys(column, source):
        return i.events.where(is_filled(column)).select(
            F.col(column).alias("k"), F.lit(source).alias("source"), F.col("time_stamp").alias("seen"))

    return lookup.best_source([keys("product_id", "direct"), keys("viewing_product_id", "viewed")], "k")


@case("jon11_udf5_ip_range", query("""
SELECT DISTINCT ip, trim(raw_code) AS country_code, raw_country AS country_name, trim(raw_region) AS region_name,
       CASE WHEN n = 7 AND CAST(split_part(ip, '.', 3) AS INTEGER) >= 128 THEN 'second half' ELSE raw_city END AS city_name
FROM (SELECT ip FROM ev UNION ALL SELECT ip FROM browse) JOIN place ON CAST(split_part(ip, '.', 2) AS INTEGER) = n
WHERE n NOT IN (3, 8)"""))
def _(i):
    located = iprange.locate(i.events, i.ip_ranges).where(F.col("error").isNull())
    return located.select("ip", F.trim("country_code").alias("country_code"), "country_name",
                          F.trim("region_name").alias("region_name"), "city_name")


@case("jon12_jsn1_jsn3_unnest", query("""
SELECT source_event_id, CAST(pos AS INTEGER) AS pos, pos = item_index AS has_product
FROM ev, (VALUES (0), (1)) p(pos) WHERE NOT broken_cart"""))
def _(i):
    items = i.checkouts.select(
        F.col("_id").alias("source_event_id"),
        F.posexplode(jsontext.array_items("cart_products")).alias("pos", "item"))
    return items.select(
        "source_event_id", "pos", jsontext.scalar("item", "product_id").isNotNull().alias("has_product"))


@case("jon12_cmp8_order_cart_lines", query("""
SELECT source_event_id, item_index, order_id, product_id, amount, unit_price, currency_code FROM order_line"""))
def _(i):
    return staging.typed_lines(i.order_carts, i.rates).select(
        "source_event_id", "item_index", "order_id", "product_id", "amount", "unit_price", "currency_code")


@case("jon14_dq5_relationship", """
SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey % 211 = 0""")
def _(i):
    products = i.products.where(F.col("product_id").isNotNull()).select(
        F.col("product_id").cast("bigint").alias("product_id"))
    return quality.relationship(i.table("lineitem"), "l_partkey", products, "product_id").select(
        "l_orderkey", "l_partkey")


@case("jon15_dq14_same_row_count", """
SELECT * FROM (SELECT (SELECT count(*) FROM orders) AS left_count, (SELECT count(*) FROM customer) AS right_count)
WHERE left_count <> right_count""")
def _(i):
    return quality.same_row_count(i.table("orders"), i.table("customer"), "left_count", "right_count")


# ---- aggregates --------------------------------------------------------------------------

@case("agg1_store_hosts", query("""
SELECT store_id, host, count(*) AS cnt FROM ev WHERE l_orderkey % 13 <> 0 GROUP BY ALL"""))
def _(i):
    # Grouping by an alias that is also a raw column would bind to the raw column.
    seen = i.checkouts.where(F.col("current_url").isNotNull()).select(
        blank_to_null("store_id").alias("store"), url_host("current_url").alias("host"))
    return seen.groupBy(F.col("store").alias("store_id"), "host").agg(cnt())


@case("agg2_order_span", query("SELECT min(order_date) AS first, max(order_date) AS last FROM cart"))
def _(i):
    cart = i.cart
    return cart.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))


@case("agg3_distinct_places", query("""
SELECT DISTINCT country_code, country_name, region_name, city_name, location_key FROM loc"""))
def _(i):
    return staging.location(i.ip_locations).select(
        "country_code", "country_name", "region_name", "city_name", "location_key").distinct()


@case("agg4_distinct_addresses", query("""
SELECT DISTINCT coalesce(ip, '   ') AS ip FROM ev UNION SELECT DISTINCT ip FROM browse"""))
def _(i):
    return i.events.select("ip").distinct()


@case("agg5_first_url", query("""
SELECT product_id, current_url AS url FROM browse
WHERE collection IN ('view_product_detail', 'select_product_option', 'add_to_cart_action')
  AND product_id <> '' AND current_url <> ''
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY time_stamp, _id) = 1"""))
def _(i):
    seen = i.events.where(F.col("collection").isin(catalog.PRODUCT_EVENTS)).select(
        "product_id", F.col("current_url").alias("url"), *catalog.FIRST_SEEN)
    return pick.earliest_value(
        seen.where(is_filled("product_id") & is_filled("url")), "product_id", "url", catalog.FIRST_SEEN)


@case("agg6_row_count", "SELECT count(*) AS cnt FROM lineitem")
def _(i):
    return i.table("lineitem").agg(cnt())


_PROFILE = query("""
SELECT field, count(*) AS total, count(CASE WHEN v IS NULL THEN 1 END) AS null_count,
       round(count(CASE WHEN v IS NULL THEN 1 END) * 100.0 / count(*), 2)::DOUBLE AS null_percent,
       count(DISTINCT v) AS distinct_count
FROM (SELECT unnest(['ip', 'product_id', 'viewing_product_id', 'current_url', 'referrer_url', 'collection']) AS field,
             unnest([ip, product_id, viewing_product_id, current_url, referrer_url, collection]) AS v FROM browse
      UNION ALL
      SELECT unnest(['ip', 'product_id', 'viewing_product_id', 'current_url', 'referrer_url', 'collection']),
             unnest([coalesce(ip, '   '), NULL, NULL, 'https://' || host || CASE WHEN l_orderkey % 10 = 0
                     THEN ':8443/checkout' ELSE '/checkout/success?o=' || l_orderkey END, NULL, 'checkout_success']) FROM ev)
GROUP BY field""")


@case("agg7_agg8_dq15_column_profile", _PROFILE)
def _(i):
    return profile.profile_columns(i.events, [
        "ip", "product_id", "viewing_product_id", "current_url", "referrer_url", "collection"])


@case("agg7_approximate_profile", query("""
SELECT 'user_id_db' AS field, count(*) AS total, CAST(0 AS BIGINT) AS null_count, true AS is_close
FROM (SELECT _id FROM browse UNION ALL SELECT source_event_id FROM ev)"""))
def _(i):
    exact = i.events.agg(F.count_distinct("user_id_db").alias("exact"))
    approximate = profile.profile_columns(i.events, ["user_id_db"], approximate=True)
    close = F.abs(F.col("distinct_count") - exact.scalar()) <= 0.15 * exact.scalar()
    return approximate.select("field", "total", "null_count", close.alias("is_close"))


@case("agg9_uncastable", query("""
SELECT 'order_id' AS field, count(*) AS invalid_count FROM ev
UNION ALL SELECT 'product_id', count(CASE WHEN product_id = '' THEN 1 END) FROM browse
UNION ALL SELECT 'time_stamp', 0"""))
def _(i):
    # '5979.0' and 'x101' are present but no whole numbers; product ids are numbers, empty or null.
    fields = ["order_id", "product_id", "time_stamp"]
    counts = [profile.count_uncastable(i.events, f).select(F.lit(f).alias("field"), "invalid_count") for f in fields]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@case("agg10_srt4_top_hosts", query("""
SELECT domain, count(*) AS cnt FROM urls GROUP BY domain ORDER BY cnt DESC, domain LIMIT 20"""))
def _(i):
    return catalog.top_domains(i.url_list)


@case("agg11_last_domain", query("""
SELECT product_id, arg_max(domain, page_id) AS domain FROM urls GROUP BY product_id"""))
def _(i):
    return catalog.product_domains(i.url_list, ["page_id"])


_DOC_PATHS = """
SELECT event_type AS grp, unnest(['_id', 'collection', 'value', 'props', 'props.k', 'items', 'items[]',
                                  'items[].flag', 'items[].sizes', 'items[].sizes[]']) AS path,
       unnest(['int', 'string', CASE WHEN k % 2 = 0 THEN 'float' ELSE 'null' END, 'object', 'int', 'array',
               'object', 'bool', CASE WHEN k % 3 = 0 THEN 'array' ELSE 'null' END,
               CASE WHEN k % 3 = 0 THEN 'int' END]) AS type
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events {sample})"""
_ALL_PATHS = _DOC_PATHS.format(sample="")
_SAMPLED_PATHS = _DOC_PATHS.format(
    sample="QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 10")
_TYPES = "SELECT grp, path, string_agg(DISTINCT type, ', ' ORDER BY type) AS types FROM ({}) WHERE type IS NOT NULL GROUP BY ALL"


@case("agg12_set3_srt2_type_sets", f"""
SELECT path, string_agg(DISTINCT type, ', ' ORDER BY type) AS types FROM ({_ALL_PATHS}) WHERE type IS NOT NULL GROUP BY path""")
def _(i):
    found = discovery.discover_schema(i.documents, "collection", "document", [F.asc("event_id")], sample_size=None)
    return discovery.master_fields(found)


@case("agg13_field_counts", f"""
SELECT grp, count(DISTINCT path) AS fields FROM ({_SAMPLED_PATHS}) WHERE type IS NOT NULL GROUP BY grp
UNION ALL SELECT '*', count(DISTINCT path) FROM ({_SAMPLED_PATHS}) WHERE type IS NOT NULL""")
def _(i):
    found = discovery.discover_schema(i.documents, "collection", "document", [F.asc("event_id")])
    return discovery.field_counts(found)


@case("agg14_outcome_counts", query("SELECT status, count(*) AS cnt FROM stored GROUP BY status"))
def _(i):
    return catalog.outcome_counts(catalog.parse_pages(i.product_pages))


# ---- windows -----------------------------------------------------------------------------

@case("win1_stm3_earliest_line", query("""
SELECT order_id, product_id, source_event_id, item_index, time_stamp FROM cart"""))
def _(i):
    return i.cart.select(
        "order_id", "product_id", "source_event_id", "item_index", "time_stamp")


@case("win2_most_frequent_host", query("SELECT store_id, store_domain FROM store"))
def _(i):
    return staging.store(i.events).select("store_id", "store_domain")


@case("win3_win4_customer_first_last", query("""
SELECT customer_key, customer_user_agent, customer_device_id, start_date FROM dim_cust"""))
def _(i):
    return dims.customer(i.cart).select(
        "customer_key", "customer_user_agent", "customer_device_id", "start_date")


@case("win5_one_per_address", query("SELECT ip_address, city_name FROM loc"))
def _(i):
    return staging.location(i.ip_locations).select("ip_address", "city_name")


@case("win6_first_documents", """
SELECT event_type AS collection, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 10""")
def _(i):
    return pick.first_n_per_key(i.documents, ["collection"], [F.asc("event_id")], discovery.SAMPLE_SIZE).select(
        "collection", "event_id")


# ---- sort, limit -------------------------------------------------------------------------

@case("srt3_address_sample", query("""
SELECT CAST(least(100, count(*)) AS BIGINT) AS cnt, true AS all_known FROM (
  SELECT DISTINCT coalesce(ip, '   ') AS ip FROM ev UNION SELECT DISTINCT ip FROM browse)"""))
def _(i):
    sample = i.events.select("ip").distinct().limit(100)
    known = i.events.select("ip").distinct().withColumn("known", F.lit(True))
    return sample.join(known, sample["ip"].eqNullSafe(known["ip"]), "left").agg(
        cnt(), F.bool_and(F.coalesce("known", F.lit(False))).alias("all_known"))


@case("srt5_arr2_str13_attempt_domains", query("""
SELECT product_id, own_domain || ';' || string_agg(other, ';' ORDER BY pos) AS attempts FROM (
  SELECT own.product_id, own.domain AS own_domain, top.domain AS other, pos
  FROM (SELECT product_id, arg_max(domain, page_id) AS domain FROM urls GROUP BY product_id) own,
       (SELECT domain, row_number() OVER (ORDER BY count(*) DESC, domain) AS pos FROM urls
        GROUP BY domain QUALIFY pos <= 20) top
  WHERE top.domain <> own.domain
  QUALIFY row_number() OVER (PARTITION BY own.product_id ORDER BY pos) <= 4)
GROUP BY product_id, own_domain"""))
def _(i):
    return catalog.domain_plan(i.url_list, ["page_id"]).select(
        "product_id", F.array_join("attempts", ";").alias("attempts"))


@case("srt6_trial_cap", """
SELECT DISTINCT CAST(page_id % 200 AS VARCHAR) AS product_id FROM pages ORDER BY product_id LIMIT 20""")
def _(i):
    urls = i.url_list.select("product_id").distinct()
    return catalog.open_tasks(urls, urls.where(F.lit(False)), limit=20)


# ---- set operations ----------------------------------------------------------------------

@case("set1_unknown_members", query("""
SELECT 'currency' AS dim, currency_key AS k, currency_code AS a, currency_name AS b FROM dim_cur
UNION ALL SELECT 'location', location_key, location_country_name, location_city_name FROM dim_loc
UNION ALL SELECT 'store', store_key, CAST(store_id AS VARCHAR), store_domain FROM dim_store
UNION ALL SELECT 'product', product_key, product_name, product_gender FROM dim_prod
UNION ALL SELECT 'customer', customer_key, customer_user_id_db, customer_email_address FROM dim_cust"""))
def _(i):
    stg = i.models_of_one_use
    parts = {
        "currency": dims.currency(stg["stg_currency"]).select("currency_key", "currency_code", "currency_name"),
        "location": dims.location(stg["stg_location"]).select(
            "location_key", "location_country_name", "location_city_name"),
        "store": dims.store(stg["stg_store"]).select(
            "store_key", F.col("store_id").cast("string"), "store_domain"),
        "product": dims.product(stg["stg_products"]).select("product_key", "product_name", "product_gender"),
        "customer": dims.customer(stg["stg_checkout_success_cart_items"]).select(
            "customer_key", "customer_user_id_db", "customer_email_address"),
    }
    named = [df.toDF("k", "a", "b").withColumn("dim", F.lit(n)) for n, df in parts.items()]
    rows = named[0]
    for part in named[1:]:
        rows = rows.unionByName(part)
    return rows


@case("set2_new_addresses", query("""
SELECT coalesce(ip, '   ') AS ip FROM ev UNION SELECT ip FROM browse WHERE ip IS NOT NULL EXCEPT SELECT ip FROM ipl"""))
def _(i):
    return i.events.select("ip").where(F.col("ip").isNotNull()).subtract(i.ip_locations.select("ip"))
