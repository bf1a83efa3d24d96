"""Column functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.checks.oracle import key, query
from basketry.checks.registry import case
from basketry.functions import business, dates, jsontext, keys, numbers, text
from basketry.operators import discovery, iprange, pages
from basketry.plans import catalog, staging, warehouse
from basketry.sources.readers import bundled_rate_rows

# Characters and words that are put around values for the functions to deal with.
PADS = ["", " ", "\t ", " ", "　\n", "  "]


def _padded(i):
    """Part names between every kind of white space, some of them blank."""
    pad = F.get(F.array(*[F.lit(p) for p in PADS]), (F.col("p_partkey") % len(PADS)).cast("int"))
    core = F.when(F.col("p_partkey") % 13 == 0, "").otherwise(F.col("p_name"))
    return i.table("part").select("p_partkey", F.concat(pad, core, pad).alias("padded"))


@case("str1_trim", """
SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE p_name END AS trimmed FROM part""")
def _(i):
    return _padded(i).select("p_partkey", text.strip_space("padded").alias("trimmed"))


@case("str2_cnd3_blank_to_null", """
SELECT p_partkey, CASE WHEN p_partkey % 13 <> 0 THEN p_name END AS name FROM part""")
def _(i):
    return _padded(i).select("p_partkey", text.blank_to_null("padded").alias("name"))


@case("str3_case", "SELECT doc_id, md5(upper(lang)) AS u, md5(lower(source)) AS l, length(text) AS n FROM documents")
def _(i):
    return i.table("documents").select(
        "doc_id", F.md5(F.upper("lang")).alias("u"), F.md5(F.lower("source")).alias("l"),
        F.length("text").cast("bigint").alias("n"))


@case("str4_capitalize", """
SELECT p_partkey, upper(w1[1]) || lower(w1[2:]) || sep || upper(w2[1]) || lower(w2[2:]) || sep || sep
         || 'O''x ' || upper(p_type[1]) || lower(p_type[2:]) AS title
FROM (SELECT *, split_part(p_name, ' ', 1) AS w1, split_part(p_name, ' ', 2) AS w2,
             substr('- _(/"+', CAST(p_partkey % 7 AS INTEGER) + 1, 1) AS sep FROM part)""")
def _(i):
    mark = F.get(F.array(*[F.lit(c) for c in "- _(/\"+"]), (F.col("p_partkey") % 7).cast("int"))
    raw = F.concat(F.replace("p_name", F.lit(" "), mark), mark, mark, F.lit("o'X "), "p_type")
    return i.table("part").select("p_partkey", text.capitalize_words(raw).alias("title"))


@case("str5_concat_null", """
SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_brand || '-' || p_type END AS joined FROM part""")
def _(i):
    brand = F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand"))
    return i.table("part").select("p_partkey", F.concat(brand, F.lit("-"), "p_type").alias("joined"))


@case("str6_replace", "SELECT page_id, replace(url, 'example', 'sample') AS url FROM pages")
def _(i):
    return i.table("pages").select("page_id", F.replace("url", F.lit("example"), F.lit("sample")).alias("url"))


@case("str7_regexp_contains", "SELECT page_id, regexp_matches(url, '/\\d+($|[?#/.])') AS has_number FROM pages")
def _(i):
    return i.table("pages").select("page_id", F.col("url").rlike(r"/\d+($|[?#/.])").alias("has_number"))


@case("str8_regexp_replace", "SELECT doc_id, md5(regexp_replace(text, '[.,]', '', 'g')) AS plain FROM documents")
def _(i):
    return i.table("documents").select("doc_id", F.md5(F.regexp_replace("text", "[.,]", "")).alias("plain"))


@case("str9_last_position", """
SELECT page_id, CAST(length(url) - strpos(reverse(url), '/') + 1 AS INTEGER) AS slash,
       CAST(CASE WHEN contains(url, '#') THEN length(url) - strpos(reverse(url), '#') + 1 ELSE 0 END AS INTEGER) AS hash
FROM pages""")
def _(i):
    return i.table("pages").select(
        "page_id", text.last_position("url", "/").alias("slash"), text.last_position("url", "#").alias("hash"))


@case("str11_url_host", query("""
SELECT page_id, CASE page_id % 5 WHEN 3 THEN NULL ELSE domain END AS host FROM urls"""))
def _(i):
    path = F.regexp_extract("url", "^https?://[^/]*(/.*)$", 1)
    host = F.regexp_extract("url", "^https?://([^/]*)", 1)
    variant = F.col("page_id") % 5
    disguised = (
        F.when(variant == 0, F.col("url"))
        .when(variant == 1, F.concat(F.lit(" https://user:pw@"), host, F.lit(":8443"), path))
        .when(variant == 2, F.concat(F.lit("//"), host, path))
        .when(variant == 3, path).otherwise(F.concat(host, path))
    )
    return i.table("pages").select("page_id", text.url_host(disguised).alias("host"))


@case("str12_url_authority", query("SELECT page_id, 'me@' || domain || ':81' AS authority FROM urls"))
def _(i):
    url = F.regexp_replace("url", "^(https?)://([^/]*)", "$1://me@$2:81")
    return i.table("pages").select("page_id", text.url_authority(url).alias("authority"))


@case("str14_catalog_url", query("""
SELECT page_id, 'https://' || domain || '/catalog/product/view/id/' || page_id AS url FROM urls"""))
def _(i):
    return i.table("pages").select("page_id", text.catalog_url(
        text.url_authority("url"), F.col("page_id").cast("string")).alias("url"))


@case("hsh1_surrogate_key", f"""
SELECT o_orderkey, {key("CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderkey AS VARCHAR) END")} AS k FROM orders""")
def _(i):
    value = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderkey").cast("string"))
    return i.table("orders").select("o_orderkey", keys.surrogate_key(value).alias("k"))


@case("hsh2_mask_email", """
SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN sha256('user' || c_custkey || '@example.com') END AS masked FROM customer""")
def _(i):
    email = F.when(F.col("c_custkey") % 11 != 0, F.concat(
        F.lit("\t User"), F.col("c_custkey").cast("string"), F.lit("@Example.COM ")))
    return i.table("customer").select("c_custkey", keys.mask_email(email).alias("masked"))


@case("cst1_to_long", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS n FROM orders""")
def _(i):
    k = F.col("o_orderkey")
    raw = F.concat(k.cast("string"), F.when(k % 3 == 1, ".5").when(k % 3 == 2, "x").otherwise(""))
    return i.table("orders").select("o_orderkey", numbers.to_long(raw).alias("n"))


@case("cst2_float_text_to_long", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL WHEN o_orderkey % 5 = 3 THEN o_orderkey + 1
                   ELSE o_orderkey END AS n FROM orders""")
def _(i):
    k = F.col("o_orderkey")
    ending = F.when(k % 5 == 0, "").when(k % 5 == 1, ".0").when(k % 5 == 2, ".4").when(k % 5 == 3, ".5").otherwise("d")
    return i.table("orders").select(
        "o_orderkey", numbers.float_text_to_long(F.concat(k.cast("string"), ending)).alias("n"))


@case("cst3_to_double", """
SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE p_retailprice END AS price FROM part""")
def _(i):
    k, price = F.col("p_partkey"), F.col("p_retailprice").cast("string")
    raw = F.when(k % 4 == 1, F.concat(F.lit(" +"), price)).when(k % 4 == 2, F.concat(price, F.lit("0e0")))
    raw = raw.when(k % 4 == 3, F.concat(price, F.lit("f"))).otherwise(price)
    return i.table("part").select("p_partkey", numbers.to_double(raw).alias("price"))


@case("cst4_to_numeric", """
SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(38,9)) AS DOUBLE) END AS price FROM part""")
def _(i):
    raw = F.when(F.col("p_partkey") % 7 == 0, "n/a").otherwise(F.col("p_retailprice").cast("string"))
    return i.table("part").select("p_partkey", numbers.to_numeric(raw).cast("double").alias("price"))


@case("cst5_cst6_strict_casts", """
SELECT CAST(c_custkey AS VARCHAR) AS t, c_custkey AS n, CAST(c_custkey AS DOUBLE) AS d FROM customer""")
def _(i):
    t = F.col("t")
    rows = i.table("customer").select(F.col("c_custkey").cast("string").alias("t"))
    return rows.select("t", t.cast("bigint").alias("n"), t.cast("decimal(38,9)").cast("double").alias("d"))


@case("dat1_dat2_timestamp_and_day", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, CAST(ts AS DATE) AS day FROM events""")
def _(i):
    seconds = dates.epoch_seconds("ts")
    moment = F.timestamp_seconds(seconds)
    return i.table("events").select(
        "event_id", F.unix_seconds(moment).alias("seconds"), dates.utc_date(seconds).alias("day"))


@case("dat3_date_key", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS k FROM orders")
def _(i):
    return i.table("orders").select("o_orderkey", dates.date_key("o_orderdate").alias("k"))


@case("dat4_dat5_calendar_parts", """
SELECT o_orderkey, strftime(o_orderdate, '%A') AS day_name, strftime(o_orderdate, '%B') AS month_name,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow, CAST(day(o_orderdate) AS INTEGER) AS dom,
       CAST(dayofyear(o_orderdate) AS INTEGER) AS doy, CAST(month(o_orderdate) AS INTEGER) AS m,
       CAST(quarter(o_orderdate) AS INTEGER) AS q, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders""")
def _(i):
    d = F.to_date("o_orderdate")
    return i.table("orders").select(
        "o_orderkey", F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "MMMM").alias("month_name"),
        F.dayofweek(d).alias("dow"), F.dayofmonth(d).alias("dom"), F.dayofyear(d).alias("doy"),
        F.month(d).alias("m"), F.quarter(d).alias("q"), F.year(d).alias("y"))


@case("dat6_sunday_week", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%U') AS BIGINT) AS week FROM orders")
def _(i):
    return i.table("orders").select("o_orderkey", dates.sunday_week("o_orderdate").alias("week"))


@case("dat7_date_spine", """
SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders""")
def _(i):
    day_ = F.to_date("o_orderdate")
    return i.table("orders").agg(F.min(day_).alias("a"), F.max(day_).alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("d"))


@case("dat10_iso_text", """
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S') AS seconds,
       CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso FROM events""")
def _(i):
    return i.table("events").select(
        "event_id", dates.iso_text(F.date_trunc("second", "ts")).alias("seconds"),
        dates.iso_text("ts").alias("iso"))


@case("mth1_cmp7_usd_price", query("""
SELECT source_event_id, CAST(round(CAST(unit_price AS DECIMAL(24,6)) * CAST(coalesce(rate_to_usd, 1) AS DECIMAL(10,6)), 2) AS DOUBLE) AS usd
FROM ev LEFT JOIN seed ON pos = symbol_no"""))
def _(i):
    number = F.expr("l_suppkey % 37")
    priced = F.when(number.isNotNull(), F.expr(
        "if(l_suppkey % 7 = 0, floor(l_extendedprice), l_extendedprice)").cast("double"))
    rate = F.get(F.array(*[F.lit(r) for r in _rates()]), number.cast("int"))
    df = i.line_items.withColumn("copy", F.expr("explode(if(l_orderkey % 17 = 0, array(0, 1), array(0)))"))
    ident = F.expr("concat_ws('-', 'e', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                   "cast(round(l_extendedprice * 100) as bigint), copy)")
    return df.select(ident.alias("source_event_id"), numbers.usd_price(priced, rate).cast("double").alias("usd"))


def _rates():
    return [row[3] for row in bundled_rate_rows()]


@case("mth2_line_revenue", query("SELECT detail_key, total_revenue_usd FROM mart"))
def _(i):
    amount = F.col("sales_amount") * F.col("sales_usd_price")
    return i.models_of_one_use[warehouse.FACT].select("detail_key", amount.cast("double").alias("total_revenue_usd"))


@case("mth3_percent", """
SELECT l_returnflag, count(*) AS total, round(count(CASE WHEN l_quantity > 25 THEN 1 END) * 100.0 / count(*), 6)::DOUBLE AS pct,
       0.0::DOUBLE AS empty FROM lineitem GROUP BY l_returnflag""")
def _(i):
    rows = i.table("lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("l_quantity") > 25).alias("large"))
    return rows.select(
        "l_returnflag", "total", F.round(numbers.share_percent("large", "total"), 6).alias("pct"),
        numbers.share_percent(F.col("large"), F.lit(0)).alias("empty"))


@case("cnd1_cmp2_gender_group", query("SELECT product_id, product_gender FROM prod"))
def _(i):
    return i.products.where(F.col("product_id").isNotNull()).select(
        F.col("product_id").cast("bigint").alias("product_id"),
        business.gender_group("gender").alias("product_gender"))


@case("cnd2_defaults", query("""
SELECT product_id, coalesce(product_min_price, 0.0::DOUBLE) AS low, coalesce(product_name, 'Not In Catalog') AS name FROM prod"""))
def _(i):
    low = F.coalesce(numbers.to_numeric("min_price"), F.lit(0)).cast("double")
    return i.products.where(F.col("product_id").isNotNull()).select(
        F.col("product_id").cast("bigint").alias("product_id"), low.alias("low"),
        F.coalesce(text.blank_to_null("name"), F.lit("Not In Catalog")).alias("name"))


@case("jsn2_json_scalar", query("""
SELECT source_event_id, CAST(product_id AS VARCHAR) AS product_id, CAST(amount AS VARCHAR) AS amount,
       CAST(NULL AS VARCHAR) AS option FROM ev WHERE NOT broken_cart"""))
def _(i):
    items = i.checkouts.select(
        F.col("_id").alias("source_event_id"), F.explode(jsontext.array_items("cart_products")).alias("item"))
    rows = items.select("source_event_id", *[
        jsontext.scalar("item", f).alias(f) for f in ("product_id", "amount", "option")])
    return rows.where(F.col("product_id").isNotNull())


@case("jsn4_round_trip", "SELECT event_id, props AS before, replace(props, ' ', '') AS after FROM events")
def _(i):
    return i.table("events").select(
        "event_id", F.col("props").alias("before"), F.to_json(F.parse_json("props")).alias("after"))


@case("arr1_first_element", query("""
SELECT _id, CASE WHEN k % 2 = 0 THEN '{"option_label":"alloy","value_id":' || k || '}' END AS first_option FROM browse"""))
def _(i):
    first = F.get(jsontext.array_items("option"), 0)
    return i.browsing.select("_id", first.alias("first_option"))


# ---- composite column operators ----------------------------------------------------------

@case("cmp1_udf1_parse_price", query("SELECT source_event_id, CAST(unit_price AS DOUBLE) AS price FROM ev"))
def _(i):
    whole = F.expr("if(l_suppkey % 7 = 0, format_number(floor(l_extendedprice), 0), format_number(l_extendedprice, 2))")
    written = F.when(F.expr("l_linenumber % 2 = 1"), whole).otherwise(F.translate(whole, ",.", ".,"))
    df = i.line_items.withColumn("copy", F.expr("explode(if(l_orderkey % 17 = 0, array(0, 1), array(0)))"))
    ident = F.expr("concat_ws('-', 'e', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
                   "cast(round(l_extendedprice * 100) as bigint), copy)")
    return df.select(ident.alias("source_event_id"), numbers.parse_price(written).alias("price"))


@case("cmp3_location_clean", query("""
SELECT c_custkey, copy, country_code, country_name, region_name, city_name FROM ipl"""))
def _(i):
    return i.ip_locations.select(
        F.regexp_extract("_id", r"^l(\d+)-", 1).cast("bigint").alias("c_custkey"),
        F.regexp_extract("_id", r"-(\d)$", 1).cast("int").alias("copy"),
        business.country_code("country_code").alias("country_code"),
        *[business.place_name(c).alias(c) for c in ("country_name", "region_name", "city_name")])


@case("cmp4_location_key", query("SELECT ip_address, location_key FROM loc"))
def _(i):
    return staging.location(i.ip_locations).select("ip_address", "location_key")


@case("cmp5_currency_key", query("SELECT currency_symbol, currency_key FROM cur"))
def _(i):
    return staging.currency(i.events, i.rates).select("currency_symbol", "currency_key")


@case("cmp6_unknown_fallback", query("""
SELECT count(CASE WHEN product_key = -1 THEN 1 END) AS products, count(CASE WHEN location_key = -1 THEN 1 END) AS locations,
       count(CASE WHEN currency_key = -1 THEN 1 END) AS currencies, count(CASE WHEN store_key = -1 THEN 1 END) AS stores,
       count(CASE WHEN customer_key = -1 THEN 1 END) AS customers FROM fact"""))
def _(i):
    names = {"products": "product_key", "locations": "location_key", "currencies": "currency_key",
             "stores": "store_key", "customers": "customer_key"}
    return i.models_of_one_use[warehouse.FACT].agg(*[F.count_if(F.col(k) == keys.UNKNOWN_KEY).alias(n) for n, k in names.items()])


@case("cmp8_detail_keys", query("SELECT order_id, product_id, detail_key, order_product_key FROM (SELECT *, sold_product_id AS product_id FROM fact)"))
def _(i):
    o, p, n = F.col("order_id"), F.col("product_id"), F.col("item_index")
    return i.cart.select("order_id", "product_id", keys.joined_key(o, p, n).alias("detail_key"),
                         keys.joined_key(o, p).alias("order_product_key"))


@case("cmp9_udf3_embedded_json", query("""
SELECT page_id, CASE WHEN v = 4 THEN '{}' WHEN has_data THEN json_extract_string(data, '$.sku') END AS sku,
       CASE WHEN has_data THEN json_extract_string(data, '$.name') END AS name,
       CASE WHEN has_data THEN CAST(page_id * 1.5::DOUBLE AS VARCHAR) END AS price FROM stored"""))
def _(i):
    found = pages.embedded_json("html")
    rows = i.product_pages.select("page_id", jsontext.once(found).alias("json"))
    parsed = jsontext.fields("json", ["sku", "name", "price"])
    sku = F.when(F.col("json") == "{}", "{}").otherwise(parsed["sku"])
    return rows.select("page_id", sku.alias("sku"), parsed["name"].alias("name"), parsed["price"].alias("price"))


_RECORD = query("""
SELECT task_id, attempt, status,
       CASE WHEN has_data AND page_id % 3 > 0 THEN CAST(1000 + page_id AS VARCHAR) ELSE task_id END AS product_id,
       'https://' || domain || '/catalog/product/view/id/' || task_id AS source_url, domain AS domain_used,
       CASE WHEN has_data THEN json_extract_string(data, '$.name') END AS name,
       CASE WHEN has_data THEN CAST(page_id * 1.5::DOUBLE AS VARCHAR) END AS price,
       CASE WHEN NOT has_data THEN NULL WHEN page_id % 5 = 0 THEN 'kids' WHEN page_id % 2 = 0 THEN 'women' ELSE 'men' END AS gender,
       CASE WHEN has_data THEN CAST(page_id % 4 AS VARCHAR) END AS massiv FROM stored""")


@case("cmp10_mod19_product_record", _RECORD)
def _(i):
    return catalog.parse_pages(i.product_pages).select(
        "task_id", "attempt", "status", "product_id", "source_url", "domain_used", "name", "price", "gender", "massiv")


@case("cmp11_page_outcome", query("SELECT task_id, attempt, status FROM stored"))
def _(i):
    return catalog.parse_pages(i.product_pages).select("task_id", "attempt", "status")


@case("cmp12_meta_content", """
SELECT page_id, 'Title ' || page_id AS title, CAST(NULL AS VARCHAR) AS missing FROM pages""")
def _(i):
    tag = F.concat(F.lit('<meta property="og:title" content=" Title '), F.col("page_id").cast("string"), F.lit(' ">'))
    html = F.replace("html", F.lit("</head>"), F.concat(tag, F.lit("</head>")))
    html = F.when(html.contains("og:title"), html).otherwise(F.concat(tag, "html"))
    return i.table("pages").select(
        "page_id", text.meta_content(html, "og:title").alias("title"),
        text.meta_content(html, "og:nothing").alias("missing"))


@case("cmp13_observed_type", """
SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'null' WHEN 1 THEN 'bool' WHEN 2 THEN 'int' WHEN 3 THEN 'float'
       WHEN 4 THEN 'string' WHEN 5 THEN 'array' ELSE 'object' END AS kind FROM events""")
def _(i):
    n = F.col("event_id") % 7
    value = F.col("event_id").cast("string")
    raw = (
        F.when(n == 0, "null").when(n == 1, "true").when(n == 2, value)
        .when(n == 3, F.concat(value, F.lit(".5"))).when(n == 4, F.concat(F.lit('"'), value, F.lit('"')))
        .when(n == 5, F.concat(F.lit("["), value, F.lit("]"))).otherwise(F.col("props"))
    )
    return i.table("events").select("event_id", jsontext.observed_type(F.parse_json(raw)).alias("kind"))


@case("cmp14_udf4_document_paths", """
SELECT DISTINCT grp, path, type FROM (
SELECT event_type AS grp, unnest(['_id', 'collection', 'value', 'props', 'props.k', 'items', 'items[]',
                                  'items[].flag', 'items[].sizes', 'items[].sizes[]']) AS path,
       unnest(['int', 'string', CASE WHEN k % 2 = 0 THEN 'float' ELSE 'null' END, 'object', 'int', 'array',
               'object', 'bool', CASE WHEN k % 3 = 0 THEN 'array' ELSE 'null' END,
               CASE WHEN k % 3 = 0 THEN 'int' END]) AS type
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)) WHERE type IS NOT NULL""")
def _(i):
    return discovery.document_paths(i.documents, "collection", "document").distinct()


@case("cmp15_ip_enrich", query("""
SELECT DISTINCT ip, trim(raw_code) AS country_code, CAST(NULL AS VARCHAR) AS error
FROM (SELECT ip FROM ev UNION ALL SELECT ip FROM browse)
     JOIN place ON CAST(split_part(ip, '.', 2) AS INTEGER) = n WHERE n NOT IN (3, 8)
UNION ALL
SELECT DISTINCT coalesce(ip, '   '), NULL, 'invalid_ip_address' FROM (
  SELECT 'bad-' || _id AS ip FROM browse UNION ALL SELECT 'bad-' || source_event_id FROM ev
  UNION ALL SELECT ip FROM ev WHERE ip IS NULL)"""))
def _(i):
    broken = i.events.select(F.concat(F.lit("bad-"), "_id").alias("ip"))
    located = iprange.locate(i.events.select("ip").unionByName(broken), i.ip_ranges)
    return located.select("ip", F.trim("country_code").alias("country_code"), "error")
