"""SQL building blocks for the checks.

They compute each answer from the relational tables, not from the JSON documents and
texts the Spark side has to take apart.
"""

from __future__ import annotations

import re

from basketry.sources.readers import bundled_rate_rows


def key(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def ip(number: str) -> str:
    return f"'10.' || ({number} % 25) || '.' || (({number} // 256) % 256) || '.' || ({number} % 256)"


def day(seconds: str) -> str:
    return f"(DATE '1970-01-01' + CAST({seconds} // 86400 AS INTEGER))"


def cents(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(20,2))) AS DOUBLE)"


_SEED = ",\n".join(
    f"  ('{s}', '{c}', '{n}', CAST({r!r} AS DOUBLE), {i})"
    for i, (s, c, n, r) in enumerate(bundled_rate_rows())
)

# Named subqueries; each may use the others.
PARTS: dict[str, str] = {
    "seed": f"""
SELECT * FROM (VALUES
{_SEED}) v(currency_symbol, currency_code, currency_name, rate_to_usd, pos)""",
    # every checkout event, with the fields of its one real cart item
    "ev": f"""
SELECT 'e-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-'
         || CAST(round(l_extendedprice * 100) AS BIGINT) || '-' || copy AS source_event_id,
       CAST(CASE WHEN l_linenumber % 2 = 1 THEN 0 ELSE 1 END AS BIGINT) AS item_index,
       CAST(epoch(o_orderdate) AS BIGINT) + l_linenumber * 10 + copy * 60 AS time_stamp,
       CAST(o_orderdate AS VARCHAR) AS local_time,
       CASE WHEN o_custkey % 97 <> 0 THEN {ip('o_custkey')} END AS ip,
       CASE WHEN o_custkey % 83 <> 0 THEN CAST(o_custkey % 25 AS VARCHAR) END AS store_id,
       CASE WHEN o_custkey % 50 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS user_id_db,
       CASE WHEN o_custkey % 11 <> 0 THEN 'User' || o_custkey || '@Example.COM' END AS email_address,
       'dev-' || (l_orderkey % 997) AS device_id,
       o_orderpriority AS user_agent,
       CASE WHEN l_orderkey % 101 <> 0 THEN l_orderkey END AS order_id,
       l_partkey AS product_id,
       CAST(l_quantity AS BIGINT) AS amount,
       CASE WHEN l_suppkey % 7 = 0 THEN floor(l_extendedprice) ELSE l_extendedprice END AS unit_price,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL
            WHEN l_orderkey % 10 = 0 THEN 'm.shop' || (o_custkey % 25) || '.example.net'
            ELSE 'shop' || (o_custkey % 25) || '.example.com' END AS host,
       l_suppkey % 37 AS symbol_no,
       l_partkey % 500 = 0 AS broken_cart,
       l_orderkey, l_linenumber, l_suppkey, o_custkey
FROM lineitem JOIN orders ON l_orderkey = o_orderkey, (VALUES (0), (1)) c(copy)
WHERE copy = 0 OR l_orderkey % 17 = 0""",
    # cart items before duplicates are dropped
    "item": f"""
SELECT ev.*, {day('time_stamp')} AS order_date,
       CASE symbol_no WHEN 36 THEN NULL WHEN 35 THEN 'UNK' ELSE seed.currency_code END AS currency_code,
       {key('user_id_db')} AS customer_key
FROM ev LEFT JOIN seed ON pos = symbol_no WHERE NOT broken_cart""",
    "cart": """
SELECT * FROM item QUALIFY row_number() OVER (
  PARTITION BY order_id, product_id ORDER BY time_stamp, source_event_id, item_index) = 1""",
    # one checkout event per order (two for some), with a line for each of its items
    "order_line": """
SELECT 'c-' || l_orderkey || '-' || copy AS source_event_id, place AS item_index,
       CAST(epoch(o_orderdate) AS BIGINT) + copy * 60 AS time_stamp,
       CASE WHEN l_orderkey % 101 <> 0 THEN l_orderkey END AS order_id, l_partkey % 40 AS product_id,
       CAST(l_quantity AS BIGINT) AS amount, l_extendedprice AS unit_price,
       CASE l_suppkey % 37 WHEN 36 THEN NULL WHEN 35 THEN 'UNK' ELSE seed.currency_code END AS currency_code
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
                                   l_quantity, l_extendedprice) - 1 AS place FROM lineitem)
     JOIN orders ON l_orderkey = o_orderkey JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR l_orderkey % 17 = 0
     LEFT JOIN seed ON pos = l_suppkey % 37""",
    "prod": f"""
SELECT {key('CAST(p_partkey AS VARCHAR)')} AS product_key, p_partkey AS product_id,
       CASE WHEN p_partkey % 53 <> 0 THEN p_name END AS product_name, p_brand AS product_sku,
       CASE WHEN p_size % 11 IN (0, 1, 5, 9) THEN 'Female' WHEN p_size % 11 = 2 THEN 'Male'
            WHEN p_size % 11 IN (3, 4) THEN 'Kids' ELSE 'Unknown' END AS product_gender,
       p_retailprice AS product_base_price,
       CASE WHEN p_partkey % 9 <> 0 THEN p_retailprice END AS product_min_price,
       CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END AS product_max_price
FROM part WHERE p_partkey % 211 <> 0""",
    # raw and cleaned place of each nation
    "place": """
SELECT n_nationkey AS n, lower(r_name) AS region,
       CASE WHEN n_nationkey IN (3, 4) THEN 'UNK' ELSE 'X' || chr(65 + n_nationkey) END AS country_code,
       CASE WHEN n_nationkey IN (3, 6) THEN 'UNK' ELSE 'Nation_' || n_nationkey END AS country_name,
       CASE WHEN n_nationkey IN (3, 6) THEN 'UNK' ELSE title END AS region_name,
       CASE WHEN n_nationkey IN (3, 5) THEN 'UNK'
            ELSE 'Saint-' || title || ' ' || n_nationkey END AS city_name,
       CASE n_nationkey WHEN 3 THEN '-' WHEN 4 THEN 'usa'
            ELSE ' x' || chr(97 + n_nationkey) || ' ' END AS raw_code,
       CASE n_nationkey WHEN 3 THEN '-' WHEN 6 THEN 'INVALID IP ADDRESS' ELSE lower(n_name) END AS raw_country,
       CASE n_nationkey WHEN 3 THEN '-' WHEN 6 THEN '  ' ELSE lower(r_name) END AS raw_region,
       CASE n_nationkey WHEN 3 THEN '-' WHEN 5 THEN 'IPV6 address missing in bin'
            ELSE 'saint-' || lower(r_name) || ' ' || n_nationkey END AS raw_city
FROM nation JOIN (SELECT *, CASE r_name WHEN 'MIDDLE EAST' THEN 'Middle East'
                            ELSE upper(r_name[1]) || lower(r_name[2:]) END AS title FROM region)
  ON n_regionkey = r_regionkey""",
    # raw location rows, cleaned, before one is chosen per address
    "ipl": f"""
SELECT c_custkey, copy, {ip('c_custkey')} AS ip_address,
       CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE '' END || {ip('c_custkey')} AS ip,
       country_code, country_name, region_name,
       CASE WHEN copy = 1 THEN 'Zz Alternative' ELSE city_name END AS city_name,
       raw_code, raw_country, raw_region,
       CASE WHEN copy = 1 THEN 'zz alternative' ELSE raw_city END AS raw_city
FROM customer JOIN place ON n = c_custkey % 25, (VALUES (0), (1)) c(copy)
WHERE c_custkey % 3 <> 0 AND c_custkey % 97 <> 0 AND (copy = 0 OR c_custkey % 20 = 0)""",
    "loc": f"""
SELECT CASE WHEN country_code = 'UNK' AND region_name = 'UNK' AND city_name = 'UNK' THEN -1
            ELSE {key("country_code || '-' || region_name || '-' || city_name")} END AS location_key,
       ip_address, country_code, country_name, region_name, city_name
FROM ipl QUALIFY row_number() OVER (PARTITION BY ip_address
  ORDER BY country_code, region_name, city_name, country_name) = 1""",
    "store": f"""
SELECT {key('store_id')} AS store_key, store_id, host AS store_domain FROM (
  SELECT store_id, host, count(*) AS cnt FROM ev
  WHERE l_orderkey % 13 <> 0 GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY cnt DESC, host ASC NULLS LAST) = 1""",
    "cur": f"""
SELECT DISTINCT CASE WHEN symbol_no = 35 OR symbol_no = 36 THEN -1
            ELSE {key('seed.currency_code')} END AS currency_key,
       CASE symbol_no WHEN 36 THEN NULL WHEN 35 THEN '¤?' ELSE seed.currency_symbol END AS currency_symbol,
       coalesce(seed.currency_code, 'UNK') AS currency_code, seed.currency_name
FROM (SELECT symbol_no FROM ev WHERE NOT broken_cart
      UNION ALL SELECT 0 FROM ev WHERE NOT broken_cart) LEFT JOIN seed ON pos = symbol_no""",
    "dim_cur": """
SELECT DISTINCT currency_key, currency_code, currency_name FROM cur WHERE currency_key <> -1
UNION ALL SELECT -1, 'UNK', 'Unknown'""",
    "dim_prod": """
SELECT product_key, product_id, product_name, product_sku, product_gender,
       coalesce(product_base_price, 0.0::DOUBLE) AS product_base_price,
       coalesce(product_min_price, 0.0::DOUBLE) AS product_min_price,
       coalesce(product_max_price, 0.0::DOUBLE) AS product_max_price FROM prod
UNION ALL SELECT -1, -1, 'UNKNOWN', NULL, 'Unknown', 0, 0, 0""",
    "dim_loc": """
SELECT DISTINCT location_key, city_name AS location_city_name, region_name AS location_region_name,
       country_name AS location_country_name, country_code AS location_country_code
FROM loc WHERE location_key <> -1
UNION ALL SELECT -1, NULL, NULL, 'Unknown', NULL""",
    "dim_store": """
SELECT store_key, CAST(store_id AS BIGINT) AS store_id, store_domain FROM store
UNION ALL SELECT -1, -1, 'unknown'""",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS full_date,
       CAST(dayofweek(d) + 1 AS BIGINT) AS day_of_week, strftime(d, '%A') AS day_name,
       CAST(day(d) AS BIGINT) AS day_of_month, CAST(dayofyear(d) AS BIGINT) AS day_of_year,
       CAST(strftime(d, '%U') AS BIGINT) AS week_of_year, CAST(month(d) AS BIGINT) AS month_number,
       strftime(d, '%B') AS month_name, CAST(quarter(d) AS BIGINT) AS quarter_number,
       CAST(year(d) AS BIGINT) AS year_number, dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS d FROM cart)""",
    "dim_cust": """
SELECT customer_key, user_agent AS customer_user_agent, user_id_db AS customer_user_id_db,
       device_id AS customer_device_id, sha256(lower(email_address)) AS customer_email_address,
       first_day AS start_date, CAST(NULL AS DATE) AS end_date, true AS is_current
FROM (SELECT *, min(order_date) OVER (PARTITION BY customer_key) AS first_day
      FROM cart WHERE user_id_db IS NOT NULL)
QUALIFY row_number() OVER (PARTITION BY customer_key
  ORDER BY time_stamp DESC, source_event_id DESC, item_index DESC) = 1
UNION ALL SELECT -1, NULL, 'UNKNOWN', NULL, NULL, NULL, NULL, true""",
    "rate": "SELECT DISTINCT currency_code, rate_to_usd FROM seed",
    "fact": f"""
SELECT {key("cart.order_id || '-' || cart.product_id || '-' || item_index")} AS detail_key,
       {key("cart.order_id || '-' || cart.product_id")} AS order_product_key,
       coalesce(cart.customer_key, -1) AS customer_key, coalesce(product_key, -1) AS product_key,
       coalesce(location_key, -1) AS location_key, coalesce(currency_key, -1) AS currency_key,
       coalesce(store_key, -1) AS store_key, cart.order_id,
       CAST(strftime(order_date, '%Y%m%d') AS BIGINT) AS date_key, local_time, time_stamp, ip,
       amount AS sales_amount, unit_price AS sales_local_price,
       CAST(round(CAST(unit_price AS DECIMAL(24,6)) * CAST(coalesce(rate_to_usd, 1) AS DECIMAL(10,6)), 2)
            AS DOUBLE) AS sales_usd_price,
       cart.product_id AS sold_product_id
FROM cart LEFT JOIN loc ON ip_address = ip
     LEFT JOIN (SELECT * FROM dim_cur WHERE currency_key <> -1) dc ON dc.currency_code = cart.currency_code
     LEFT JOIN store ON store.store_id = cart.store_id
     LEFT JOIN prod ON prod.product_id = cart.product_id
     LEFT JOIN rate ON rate.currency_code = cart.currency_code""",
    "mart": """
SELECT detail_key, order_id, time_stamp, full_date, year_number, quarter_number, month_number,
       month_name, day_name, is_weekend, p.product_id,
       coalesce(p.product_name, 'Not In Catalog') AS product_name, p.product_sku,
       coalesce(p.product_gender, 'Not In Catalog') AS product_gender,
       location_city_name, location_region_name, location_country_name, location_country_code,
       store_domain, dc.currency_code, customer_key, sales_amount, sales_local_price, sales_usd_price,
       CAST(sales_amount * CAST(sales_usd_price AS DECIMAL(20,2)) AS DOUBLE) AS total_revenue_usd
FROM fact LEFT JOIN dim_date d ON d.date_key = fact.date_key
     LEFT JOIN dim_prod p ON p.product_key = fact.product_key
     LEFT JOIN dim_loc l ON l.location_key = fact.location_key
     LEFT JOIN dim_cur dc ON dc.currency_key = fact.currency_key
     LEFT JOIN dim_store s ON s.store_key = fact.store_key""",
    # browse events
    "browse": f"""
SELECT 'b' || event_id AS _id, CAST(floor(epoch(ts)) AS BIGINT) AS time_stamp,
       CASE WHEN user_id % 29 <> 0 THEN {ip('(user_id * 7)')} END AS ip,
       CAST(user_id AS VARCHAR) AS user_id_db,
       CASE WHEN k % 25 <> 3 THEN 'https://shop' || (user_id % 25) || '.example.com/p/' || event_id END AS current_url,
       CASE WHEN event_type = 'error' THEN 'https://m.shop' || (user_id % 25) || '.example.net/r/' || event_id END AS referrer_url,
       k % 2 = 0 AS recommendation,
       CASE WHEN k % 5 = 0 THEN 'feed' END AS utm_source,
       CASE event_type WHEN 'view' THEN 'view_product_detail' WHEN 'click' THEN 'select_product_option'
            WHEN 'signup' THEN 'view_listing_page' WHEN 'purchase' THEN 'add_to_cart_action'
            WHEN 'error' THEN 'product_view_all_recommend_clicked' END AS collection,
       CASE WHEN event_type <> 'error' AND k % 10 = 1 THEN ''
            WHEN event_type <> 'error' AND k % 10 <> 0 THEN CAST(event_id % 300 AS VARCHAR) END AS product_id,
       CASE WHEN event_type = 'error' OR k % 10 = 0
            THEN CASE WHEN k % 10 = 1 THEN '' ELSE CAST(event_id % 400 AS VARCHAR) END END AS viewing_product_id,
       event_id, event_type, user_id, k
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)""",
    # host parts of the page urls: all of them are http(s)://host/path
    "urls": """
SELECT page_id, url, CAST(page_id % 200 AS VARCHAR) AS product_id,
       split_part(split_part(url, '//', 2), '/', 1) AS domain FROM pages""",
    # what a stored page should yield; only its length depends on the embedded text
    "stored": """
SELECT *, CASE WHEN page_length < 1000 THEN 'empty_or_too_short'
               WHEN native_denied OR v = 5 THEN 'access_denied'
               WHEN native_404 OR v = 6 THEN '404_not_found'
               WHEN NOT has_data THEN 'react_data_not_found'
               WHEN v = 3 THEN 'no_product_name_found' ELSE 'ok' END AS status
FROM (
SELECT page_id, page_id % 8 AS v, CAST(page_id // 2 AS VARCHAR) AS task_id,
       CAST(page_id % 2 AS INTEGER) AS attempt, 'shop' || (page_id % 25) || '.example.com' AS domain,
       page_id % 8 IN (3, 5, 6, 7) AS has_data, data,
       length(html) + length(CASE page_id % 8 WHEN 5 THEN '<p>Access Denied</p>'
                                  WHEN 6 THEN '<p>Page NOT found</p>' ELSE '' END)
         + CASE page_id % 8 WHEN 0 THEN 0 WHEN 1 THEN 18 + 20 WHEN 2 THEN 18 + 12
                WHEN 4 THEN 18 + 3 ELSE 18 + length(data) + 23 END AS page_length,
       lower(html) LIKE '%404 not found%' OR lower(html) LIKE '%page not found%' AS native_404,
       html LIKE '%Access Denied%' AS native_denied, html
FROM (SELECT *, '{' || CASE WHEN page_id % 3 > 0 THEN '"product_id":' || (1000 + page_id) || ',' ELSE '' END
         || CASE WHEN page_id % 8 <> 3 THEN '"name":"Ring {\\"' || page_id || '\\\\\\"} x",' ELSE '' END
         || '"sku":"SKU-' || page_id || '","price":' || CAST(page_id * 1.5::DOUBLE AS VARCHAR)
         || ',"attributes":{"gender":{"value":"' || CASE WHEN page_id % 2 = 0 THEN 'women' ELSE 'men' END
         || '"},"massiv":{"value":"' || (page_id % 4) || '"}}'
         || CASE page_id % 5 WHEN 0 THEN ',"gender":"kids"' WHEN 1 THEN ',"gender":""' ELSE '' END || '}' AS data
      FROM pages))""",
    # five stored pages a product, each on one of its planned domains; attempts up to the first
    # that goes well or whose page is missing
    "crawl_top": """
SELECT domain, row_number() OVER (ORDER BY count(*) DESC, domain) AS pos FROM stored GROUP BY domain QUALIFY pos <= 20""",
    "crawl_domain": """
SELECT q, 0 AS attempt, domain FROM (SELECT page_id // 5 AS q, arg_max(domain, page_id) AS domain FROM stored GROUP BY q)
UNION ALL
SELECT q, row_number() OVER (PARTITION BY q ORDER BY pos) AS attempt, crawl_top.domain
FROM (SELECT page_id // 5 AS q, arg_max(domain, page_id) AS own FROM stored GROUP BY q) JOIN crawl_top ON crawl_top.domain <> own
QUALIFY attempt <= 4""",
    "crawl_attempt": """
SELECT q, attempt, domain, status, page_id FROM (
  SELECT *, count(*) OVER (PARTITION BY q ORDER BY attempt) = attempt + 1 AS gapless,
         coalesce(sum(CASE WHEN status = 'ok' THEN 1 END) OVER (
           PARTITION BY q ORDER BY attempt ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS needed
  FROM (SELECT page_id // 5 AS q, (page_id + page_id // 5) % 5 AS attempt, status, page_id FROM stored WHERE page_id % 9 <> 4)
  JOIN crawl_domain USING (q, attempt))
WHERE gapless AND needed""",
}


def query(body: str) -> str:
    """A statement with just the named subqueries it needs, in order of dependence."""
    needed: list[str] = []

    def add(sql: str) -> None:
        for name in PARTS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", sql):
                add_part(name)

    def add_part(name: str) -> None:
        add(PARTS[name])
        if name not in needed:
            needed.append(name)

    add(body)
    head = ",\n".join(f"{name} AS ({PARTS[name]})" for name in needed)
    return f"WITH {head}\n{body}" if needed else body
