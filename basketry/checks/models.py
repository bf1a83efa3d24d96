"""Warehouse models, reports, data tests and streams."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, Window, functions as F

from basketry.checks.oracle import cents, query
from basketry.checks.registry import case
from basketry.operators import discovery, iprange, profile, quality
from basketry.plans import catalog, dims, enrichment, facts, mart, reports, staging, warehouse
from basketry.plans.ledger import AttemptLedger
from basketry.session import cut_lineage, fresh_path
from basketry.sinks import writers
from basketry.sinks.merge import merge_by_key
from basketry.sources import readers, schemas
from basketry.streaming import dedupe, earliest, ingest

DECIMALS = ["product_base_price", "product_min_price", "product_max_price", "rate_to_usd",
            "sales_local_price", "sales_usd_price"]


def shown(df, *drop):
    """Audit columns and instants left out, decimals as doubles: what the SQL can state."""
    df = df.drop(*dims.AUDIT, *drop)
    return df.select(*[
        F.col(c).cast("double").alias(c) if c in DECIMALS else F.col(c) for c in df.columns])


_CART = """
SELECT source_event_id, item_index, time_stamp, order_date, local_time, ip, store_id, user_id_db, customer_key,
       email_address, device_id, user_agent, order_id, product_id, amount, unit_price, currency_code FROM cart"""


@case("mod1_cart_items", query(_CART))
def _(i):
    return i.cart.drop("event_timestamp")


@case("mod1_win1_order_carts", query("""
SELECT order_id, product_id, source_event_id, item_index, time_stamp, amount, unit_price, currency_code
FROM order_line QUALIFY row_number() OVER (
  PARTITION BY order_id, product_id ORDER BY time_stamp, source_event_id, item_index) = 1"""))
def _(i):
    return staging.checkout_cart_items(i.order_carts, i.rates).select(
        "order_id", "product_id", "source_event_id", "item_index", "time_stamp", "amount", "unit_price", "currency_code")


@case("mod2_currency", query("SELECT * FROM cur"))
def _(i):
    return i.models["stg_currency"]


@case("mod3_location", query("SELECT * FROM loc"))
def _(i):
    return i.models["stg_location"]


@case("mod4_products", query("SELECT * FROM prod"))
def _(i):
    return shown(i.models["stg_products"])


@case("mod5_store", query("SELECT * FROM store"))
def _(i):
    return i.models["stg_store"]


def _dim(name, sql):
    @case(name, query(f"SELECT * FROM {sql}"))
    def _(i):
        return shown(quality.enforce_contract(i.models[name.split("_", 1)[1]], name.split("_", 1)[1]))


_dim("mod6_dim_date", "dim_date")
_dim("mod7_dim_customer", "dim_cust")
_dim("mod8_dim_product", "dim_prod")
_dim("mod9_dim_location", "dim_loc")
_dim("mod10_dim_currency", "dim_cur")
_dim("mod11_dim_store", "dim_store")


@case("mod12_fact_exchange_rate", query("""
SELECT CAST('0x' || substr(md5(date_key || '-' || d.currency_code), 1, 15) AS BIGINT) AS exchange_rate_key,
       date_key, currency_key, rate_to_usd
FROM dim_date, (SELECT * FROM dim_cur WHERE currency_key <> -1) d JOIN rate ON rate.currency_code = d.currency_code"""))
def _(i):
    return shown(quality.enforce_contract(i.models["fact_exchange_rate"], "fact_exchange_rate"))


_FACT = "SELECT * EXCLUDE (time_stamp, sold_product_id) FROM fact"


@case("mod13_fact_sales", query(_FACT))
def _(i):
    return shown(quality.enforce_contract(i.fact, warehouse.FACT), "timestamp")


@case("mod13_snk15_incremental_fact", query(_FACT))
def _(i):
    # The fact up to a day, then a merge of the look-back window around that day and all
    # later lines: the result is the fact of a full load.
    cut = datetime.date(2000, 6, 30)
    models = i.models_of_one_use
    # Read twice, so the lines are written, with the columns of the fact only.
    cart = cut_lineage(models[warehouse.CART].select(*facts.CART_COLUMNS), warehouse.CART)
    early = facts.sales_order_detail(
        cart.where(F.col("order_date") <= F.lit(cut)), models["stg_location"], models["dim_currency"],
        models["stg_store"], models["stg_products"], i.rates)
    known = early.where(F.col("order_id").isNotNull())
    late = facts.sales_order_detail(
        facts.recent(cart, cut), models["stg_location"], models["dim_currency"],
        models["stg_store"], models["stg_products"], i.rates)
    # Orders without an id never match and would be inserted again; they are set aside first.
    unkeyed = early.where(F.col("order_id").isNull() & (
        F.to_date(F.col("date_key").cast("string"), "yyyyMMdd") < F.date_sub(F.lit(cut), facts.LOOK_BACK_DAYS)))
    return shown(merge_by_key(known, late, facts.MERGE_KEYS).unionByName(unkeyed), "timestamp")


@case("mod13_stm2_snk15_two_builds", query("""
SELECT * EXCLUDE (time_stamp, sold_product_id) FROM fact
UNION ALL SELECT * EXCLUDE (time_stamp, sold_product_id) FROM fact
WHERE order_id IS NULL AND date_key BETWEEN 20000628 AND 20000630"""))
def _(i):
    # A full build with the events before a day, then an incremental one of that day with all
    # events: the fact of a full load, and again the window's lines without an order id, whose
    # key matches nothing.
    root = fresh_path(i.spark, "warehouse")
    early = i.events.where(F.col("time_stamp") < 962_409_600)  # 2000-07-01
    warehouse.build(i.spark, early, i.ip_locations, i.products, i.rates, root=root)
    again = warehouse.build(i.spark, i.events, i.ip_locations, i.products, i.rates, incremental=True,
                            as_of=datetime.date(2000, 7, 1), root=root)
    return shown(again[warehouse.FACT], "timestamp")


@case("mod14_sales_mart", query("SELECT * EXCLUDE (time_stamp) FROM mart"))
def _(i):
    return shown(quality.enforce_contract(i.mart, "mart_sales_order_detail"), "order_timestamp")


_LOCATED = """
SELECT DISTINCT ip, raw_code AS country_code, raw_country AS country_name, raw_region AS region_name,
       CASE WHEN n = 7 AND CAST(split_part(ip, '.', 3) AS INTEGER) >= 128 THEN 'second half' ELSE raw_city END AS city_name
FROM {source} JOIN place ON CAST(split_part(ip, '.', 2) AS INTEGER) = n WHERE {where}"""


_ALL_IPS = "(SELECT ip FROM ev UNION ALL SELECT ip FROM browse)"


@case("mod15_ip_full_load", query(_LOCATED.format(source=_ALL_IPS, where="n NOT IN (3, 8)")))
def _(i):
    store, csv, errors = (fresh_path(i.spark, n) for n in ("ip_location", "ip_csv", "ip_errors"))
    enrichment.write_full_load(i.events, i.ip_ranges, store=store, csv=csv, errors=errors)
    return i.spark.read.parquet(store)


@case("mod16_ip_repair_load", query(f"""
SELECT DISTINCT ip, CASE WHEN n = 8 THEN '-' ELSE raw_code END AS country_code,
       CASE WHEN n = 8 THEN '-' ELSE raw_country END AS country_name,
       CASE WHEN n = 8 THEN '-' ELSE raw_region END AS region_name,
       CASE WHEN n = 8 THEN '-' WHEN n = 7 AND CAST(split_part(ip, '.', 3) AS INTEGER) >= 128 THEN 'second half'
            ELSE raw_city END AS city_name
FROM {_ALL_IPS} JOIN place ON CAST(split_part(ip, '.', 2) AS INTEGER) = n
WHERE ip NOT IN (SELECT ip FROM ipl)"""))
def _(i):
    store, delta, errors = (fresh_path(i.spark, n) for n in ("ip_location", "ip_repair", "ip_errors"))
    i.ip_locations.select(*schemas.IP_LOCATION_COLUMNS).write.parquet(store)
    enrichment.write_repair_load(i.events, i.spark.read.parquet(store), i.ip_ranges, store=store, delta=delta, errors=errors)
    return readers.read_ip_locations(i.spark, delta).select(*schemas.IP_LOCATION_COLUMNS)


@case("mod17_ip_delta", query(f"""
SELECT ip, raw_code AS country_code, raw_country AS country_name, raw_region AS region_name, raw_city AS city_name
FROM ipl WHERE ip IN (SELECT ip FROM {_ALL_IPS}) AND c_custkey % 4 <> 1"""))
def _(i):
    number = F.regexp_extract("_id", r"^l(\d+)-", 1).cast("bigint")
    loaded = i.ip_locations.where(number % 4 == 1)
    return enrichment.delta_export(i.events, loaded, i.ip_locations)


@case("mod18_product_urls", query("""
SELECT k AS product_id, url FROM (
  SELECT coalesce(product_id, viewing_product_id) AS k, current_url AS url, time_stamp, _id, 1 AS source FROM browse
  WHERE collection IN ('view_product_detail', 'select_product_option', 'add_to_cart_action')
  UNION ALL
  SELECT viewing_product_id, referrer_url, time_stamp, _id, 2 FROM browse
  WHERE collection = 'product_view_all_recommend_clicked')
WHERE k <> '' AND url <> ''
QUALIFY row_number() OVER (PARTITION BY k ORDER BY source, time_stamp, _id) = 1"""))
def _(i):
    return catalog.product_urls(i.events)


@case("mod19_page_failures", query("""
SELECT task_id AS product_id, string_agg(domain, ';' ORDER BY attempt) AS domains_tried,
       arg_max(status, attempt) AS last_error
FROM stored GROUP BY task_id HAVING count(CASE WHEN status = 'ok' THEN 1 END) = 0"""))
def _(i):
    _, failures = catalog.split_outcomes(catalog.parse_pages(i.product_pages))
    return failures


def _worked(i) -> tuple[AttemptLedger, DataFrame]:
    """A ledger after a run that stopped, one that went on with more pages, and one with nothing left to do."""
    plan = cut_lineage(i.crawl_plan, "crawl-plan")
    stored = i.crawled(plan)
    book = AttemptLedger(i.spark, fresh_path(i.spark, "ledger"))
    book.work(plan, stored.where("page_id % 3 > 0"), order=["page_id"], rounds=2)
    book.work(plan, stored, order=["page_id"])
    assert not book.work(plan, stored, order=["page_id"])
    return book, plan


@case("stm4_attempt_ledger", query("""
SELECT CAST(q AS VARCHAR) AS product_id, CAST(1 AS INTEGER) AS pass, CAST(attempt AS INTEGER) AS attempt, domain, status
FROM crawl_attempt"""))
def _(i):
    book, _ = _worked(i)
    return book.rows().select("product_id", "pass", "attempt", "domain", "status")


@case("stm4_snk12_ledger_results", query("""
SELECT 'product' AS kind, CAST(q AS VARCHAR) AS product_id, domain AS domains, 'Ring {"' || page_id || '\\"} x' AS what
FROM crawl_attempt WHERE status = 'ok'
UNION ALL
SELECT 'failure', CAST(q AS VARCHAR), string_agg(domain, ';' ORDER BY attempt), arg_max(status, attempt)
FROM crawl_attempt GROUP BY q HAVING count(*) = 5 AND count(CASE WHEN status = 'ok' THEN 1 END) = 0
UNION ALL
SELECT 'open', CAST(q AS VARCHAR), crawl_domain.domain, NULL
FROM crawl_domain LEFT JOIN (SELECT q, count(*) AS n, bool_or(status = 'ok') AS done FROM crawl_attempt GROUP BY q) USING (q)
WHERE NOT coalesce(done, false) AND attempt = coalesce(n, 0)"""))
def _(i):
    book, plan = _worked(i)
    found = book.rows().where("product is not null").select(
        F.lit("product").alias("kind"), "product_id", F.col("product.domain_used").alias("domains"), F.col("product.name").alias("what"))
    failed = book.failures(plan).select(F.lit("failure"), "product_id", "domains_tried", "last_error")
    still = book.waiting(plan).select(F.lit("open"), "product_id", "domain", F.lit(None).cast("string"))
    return found.unionAll(failed).unionAll(still)


@case("mod20_domain_plan", query("""
SELECT own.product_id, own.domain, CAST(1 + least(4, count(*)) AS INTEGER) AS attempts
FROM (SELECT product_id, arg_max(domain, page_id) AS domain FROM urls GROUP BY product_id) own,
     (SELECT domain FROM urls GROUP BY domain QUALIFY row_number() OVER (ORDER BY count(*) DESC, domain) <= 20) top
WHERE top.domain <> own.domain GROUP BY own.product_id, own.domain"""))
def _(i):
    return catalog.domain_plan(i.url_list, ["page_id"]).select(
        "product_id", "domain", F.size("attempts").alias("attempts"))


_PATHS = """
SELECT event_type AS grp, unnest(['_id', 'collection', 'value', 'props', 'props.k', 'items', 'items[]',
                                  'items[].flag', 'items[].sizes', 'items[].sizes[]']) AS path,
       unnest(['int', 'string', CASE WHEN k % 2 = 0 THEN 'float' ELSE 'null' END, 'object', 'int', 'array',
               'object', 'bool', CASE WHEN k % 3 = 0 THEN 'array' ELSE 'null' END,
               CASE WHEN k % 3 = 0 THEN 'int' END]) AS type
FROM (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
      QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 10)"""


@case("mod21_schema_discovery", f"""
SELECT grp, path, string_agg(DISTINCT type, ', ' ORDER BY type) AS types
FROM ({_PATHS}) WHERE type IS NOT NULL GROUP BY grp, path""")
def _(i):
    return discovery.discover_schema(i.documents, "collection", "document", [F.asc("event_id")])


def _profile_sql(table, source, fields):
    return f"""
SELECT '{table}' AS table_name, field, count(*) AS total, count(CASE WHEN v IS NULL THEN 1 END) AS null_count,
       round(count(CASE WHEN v IS NULL THEN 1 END) * 100.0 / count(*), 2)::DOUBLE AS null_percent,
       count(DISTINCT v) AS distinct_count
FROM (SELECT unnest([{', '.join(repr(f) for f in fields)}]) AS field, unnest([{', '.join(fields.values())}]) AS v FROM {source})
GROUP BY field"""


# Raw texts of both kinds of events, and of the products.
_RAW_EVENTS = """(
SELECT CASE WHEN o_custkey % 97 = 0 THEN '   ' ELSE ip END AS ip, NULL AS product_id, NULL AS viewing_product_id,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL
            WHEN l_orderkey % 10 = 0 THEN 'https://m.shop' || (o_custkey % 25) || '.example.net:8443/checkout'
            ELSE 'https://shop' || (o_custkey % 25) || '.example.com/checkout/success?o=' || l_orderkey END AS current_url,
       NULL AS referrer_url, 'checkout_success' AS collection, email_address, time_stamp,
       CASE WHEN o_custkey % 50 = 0 THEN '' WHEN o_custkey % 2 = 1 THEN chr(9) || o_custkey || ' '
            ELSE CAST(o_custkey AS VARCHAR) END AS user_id_db, device_id
FROM ev
UNION ALL SELECT ip, product_id, viewing_product_id, current_url, referrer_url, collection, NULL, time_stamp, user_id_db, NULL
FROM browse)"""


def _fields(table, **values):
    return {f: values.get(f, f) for f in schemas.PROFILE_FIELDS[table]}


_PROFILED = {
    "raw_summary": (_RAW_EVENTS, _fields("raw_summary", time_stamp="CAST(time_stamp AS VARCHAR)")),
    "raw_ip_location": ("ipl", _fields("raw_ip_location", country_name="raw_country", city_name="raw_city")),
    "raw_products": ("part", _fields(
        "raw_products", product_id="CASE WHEN p_partkey % 211 <> 0 THEN CAST(p_partkey AS VARCHAR) END",
        name="CASE WHEN p_partkey % 53 = 0 THEN '  ' ELSE p_name END", sku="p_brand",
        price="CAST(p_retailprice AS VARCHAR)", category="p_type",
        gender="CASE WHEN p_size % 11 <> 8 THEN CAST(p_size % 11 AS VARCHAR) END")),
}


def _profiled(i):
    tables = {"raw_summary": i.events, "raw_ip_location": i.ip_locations, "raw_products": i.products}
    return {name: (df, schemas.PROFILE_FIELDS[name]) for name, df in tables.items()}


@case("mod22_data_profile", query(" UNION ALL ".join(_profile_sql(name, *spec) for name, spec in _PROFILED.items())))
def _(i):
    return profile.profile_tables(_profiled(i))


def _report_sql(titles, parts, checks):
    """Lines of the profile report: a fixed list of columns, then what the profile SQL says about the fields."""
    fixed = [("00", k, t) for k, t in enumerate([f"# {titles}", ""])]
    for number, (name, schema) in enumerate(parts.items(), 1):
        texts = [f"## Table `{name}`", "", "### Schema", "", "| Column | Type | Nullable |", "|---|---|---|"]
        texts += [f"| {f.name} | {f.dataType.simpleString()} | YES |" for f in schema]
        fixed += [(f"{number:02d}.1", k, t) for k, t in enumerate(texts)]
        texts = ["", None, "", "| Field | Null count | Null % | Distinct count |", "|---|---|---|---|"]
        fixed += [(f"{number:02d}.2", k, t) for k, t in enumerate(texts) if t is not None]
    fixed += [("99", k, t) for k, t in enumerate(["", "## Type checks", ""])]
    rows = ", ".join(f"('{s}', {k}, '{t}')" for s, k, t in fixed)
    tables = ", ".join(f"('{name}', '{number:02d}.2')" for number, name in enumerate(parts, 1))
    places = ", ".join(f"('{name}', '{f}', {k})" for name in parts for k, f in enumerate(schemas.PROFILE_FIELDS[name], 5))
    return f"""
SELECT 'data_profile' AS report, section, line::BIGINT AS line, text FROM (
SELECT * FROM (VALUES {rows}) v(section, line, text)
UNION ALL SELECT section, 1, '### Null and distinct counts (total ' || format('{{:,}}', max(total)) || ' rows)'
FROM profiled JOIN (VALUES {tables}) t(table_name, section) USING (table_name) GROUP BY section
UNION ALL SELECT section, line, '| ' || field || ' | ' || format('{{:,}}', null_count) || ' | ' || printf('%.2f', null_percent)
  || '% | ' || format('{{:,}}', distinct_count) || ' |'
FROM profiled JOIN (VALUES {tables}) t(table_name, section) USING (table_name)
     JOIN (VALUES {places}) p(table_name, field, line) USING (table_name, field)
UNION ALL {checks})"""


_RAW_TABLES = {"raw_summary": schemas.EVENTS, "raw_ip_location": schemas.IP_LOCATIONS, "raw_products": schemas.PRODUCTS}
_CHECKED = """
SELECT '99', 3, '- `raw_summary.time_stamp`: values that are no whole number: **0** ok'
UNION ALL SELECT '99', 4, '- `raw_products.product_id`: values that are no whole number: **0** ok'
UNION ALL SELECT '99', 5, '- `raw_products.price`: values that are no whole number: **'
  || format('{:,}', count(CASE WHEN p_retailprice <> floor(p_retailprice) OR true THEN 1 END)) || '** to be checked' FROM part"""
_PROFILE_ROWS = " UNION ALL ".join(_profile_sql(name, *spec) for name, spec in _PROFILED.items())


@case("snk17_mod22_profile_report", query(
    _report_sql("Data profile", _RAW_TABLES, _CHECKED).replace("FROM profiled", f"FROM ({_PROFILE_ROWS}) profiled")))
def _(i):
    checks = [("raw_summary", "time_stamp"), ("raw_products", "product_id"), ("raw_products", "price")]
    stored = {name: (cut_lineage(df, name), fields) for name, (df, fields) in _profiled(i).items()}
    return _written(i, reports.profile_report(i.spark, stored, checks))


@case("snk17_mod21_discovery_report", f"""
WITH seen AS (SELECT grp, path, type FROM ({_PATHS}) WHERE type IS NOT NULL),
typed AS (SELECT grp, path, string_agg(DISTINCT type, ', ' ORDER BY type) AS types FROM seen GROUP BY grp, path),
master AS (SELECT path, string_agg(DISTINCT type, ', ' ORDER BY type) AS types FROM seen GROUP BY path)
SELECT 'schema_discovery' AS report, section, line::BIGINT AS line, text FROM (
SELECT * FROM (VALUES ('0', 0, '# Schema discovery'), ('0', 1, ''), ('0', 4, ''), ('1', 0, '## All fields'), ('1', 1, ''),
                      ('1', 2, '| Field path | Types |'), ('1', 3, '|---|---|')) v(section, line, text)
UNION ALL SELECT '0', 2, '- Groups: **' || count(DISTINCT grp) || '**' FROM typed
UNION ALL SELECT '0', 3, '- Fields of all groups: **' || count(*) || '**' FROM master
UNION ALL SELECT '1', 3 + row_number() OVER (ORDER BY path), '| ' || path || ' | ' || types || ' |' FROM master
UNION ALL SELECT '2 ' || grp, unnest([0, 1, 2, 3, 4]), unnest(['', '### `' || grp || '` (' || count(*) || ' fields)', '',
                                                              '| Field path | Types |', '|---|---|']) FROM typed GROUP BY grp
UNION ALL SELECT '2 ' || grp, 4 + row_number() OVER (PARTITION BY grp ORDER BY path), '| ' || path || ' | ' || types || ' |' FROM typed)""")
def _(i):
    found = discovery.discover_schema(i.documents, "collection", "document", [F.asc("event_id")])
    return _written(i, reports.discovery_report(found))


def _written(i, lines):
    """The lines of one report, each with the text its written file has at its place.

    The text writer keeps the order of the sort: the n-th line of the parts, read in the order
    of their names, is the n-th line of the report.
    """
    lines = cut_lineage(lines, "report")
    path = fresh_path(i.spark, "reports")
    reports.write_reports(lines, path)
    place = F.row_number().over(Window.partitionBy("report").orderBy("file", "at"))
    read = (i.spark.read.text(path).select("report", F.col("value").alias("text"), F.col("_metadata.file_name").alias("file"),
                                           F.monotonically_increasing_id().alias("at")).withColumn("n", place))
    wanted = lines.withColumn("n", F.row_number().over(Window.partitionBy("report").orderBy("section", "line")))
    return wanted.drop("text").join(read.select("report", "n", "text"), ["report", "n"]).drop("n")


@case("agg7_sketches_per_load", query(f"""
SELECT field, count(*) AS total, count(CASE WHEN v IS NULL THEN 1 END) AS null_count, true AS is_close
FROM (SELECT unnest([{', '.join(repr(f) for f in _PROFILED['raw_summary'][1])}]) AS field,
             unnest([{', '.join(_PROFILED['raw_summary'][1].values())}]) AS v FROM {_RAW_EVENTS}) GROUP BY field"""))
def _(i):
    # Two loads, one of them repeated, add up to the profile of all events.
    fields, path = schemas.PROFILE_FIELDS["raw_summary"], fresh_path(i.spark, "sketches")
    for load, df in {"a": i.checkouts, "b": i.browsing}.items():
        profile.write_load_sketches(df, fields, path, load)
    profile.write_load_sketches(i.browsing, fields, path, "b")
    merged = profile.merge_sketches(i.spark.read.parquet(path)).withColumnRenamed("distinct_count", "estimate")
    exact = profile.profile_columns(i.events, fields).select("field", "distinct_count")
    close = F.abs(F.col("estimate") - F.col("distinct_count")) <= 0.05 * F.col("distinct_count")
    return merged.join(exact, "field").select("field", "total", "null_count", close.alias("is_close"))


@case("mod23_raw_export", query("""
SELECT name, count(*) AS cnt, CAST(sum(CAST('0x' || substr(md5(line), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM (
  SELECT 'events' AS name, concat_ws('|', _id, collection, time_stamp, coalesce(ip, '-'), coalesce(current_url, '-'),
                                     coalesce(product_id, '-'), coalesce(viewing_product_id, '-')) AS line FROM browse
  UNION ALL
  SELECT 'events', concat_ws('|', source_event_id, 'checkout_success', time_stamp, coalesce(ip, '   '), coalesce(
    'https://' || host || CASE WHEN l_orderkey % 10 = 0 THEN ':8443/checkout' ELSE '/checkout/success?o=' || l_orderkey END,
    '-'), '-', '-') FROM ev
  UNION ALL
  SELECT 'products', concat_ws('|', CASE WHEN p_partkey % 211 = 0 THEN '-' ELSE CAST(p_partkey AS VARCHAR) END,
    CASE WHEN p_partkey % 53 = 0 THEN '  ' ELSE ' ' || p_name || chr(9) END, p_brand, p_retailprice, p_type) FROM part)
GROUP BY name"""))
def _(i):
    paths = writers.export_all({"events": i.events, "products": i.products}, fresh_path(i.spark, "export"))
    fields = {"events": ["_id", "collection", "time_stamp", "ip", "current_url", "product_id", "viewing_product_id"],
              "products": ["product_id", "name", "sku", "price", "category"]}
    back = {"events": readers.read_events(i.spark, paths["events"]), "products": readers.read_products(i.spark, paths["products"])}
    parts = []
    for name, df in back.items():
        line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in fields[name]])
        digest = F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")
        parts.append(df.agg(F.count(F.lit(1)).alias("cnt"), F.sum(digest).alias("digest")).select(
            F.lit(name).alias("name"), "cnt", "digest"))
    return parts[0].unionAll(parts[1])


@case("mod24_stm1_snk3_file_arrival", query("""
SELECT collection, count(*) AS cnt, count(DISTINCT _id) AS ids
FROM (SELECT collection, _id FROM browse UNION ALL SELECT 'checkout_success', source_event_id FROM ev) GROUP BY collection"""))
def _(i):
    bucket, target, log = (fresh_path(i.spark, n) for n in ("bucket", "raw", "stream"))
    _drop_files(i.events.where(F.col("time_stamp") % 2 == 0), f"{bucket}/raw/summary")
    _drop_files(i.ip_locations, f"{bucket}/raw/ip_location")
    _drop_files(i.products, f"{bucket}/raw/products")
    # Not a .jsonl file: it must not be picked up.
    i.browsing.write.option("compression", "gzip").json(f"{bucket}/raw/summary/ignored")
    ingest.ingest_all(i.spark, bucket, target, log)
    # More files arrive later; a run without new files adds nothing.
    _drop_files(i.events.where(F.col("time_stamp") % 2 == 1), f"{bucket}/raw/summary")
    ingest.ingest_all(i.spark, bucket, target, log)
    again = ingest.ingest_all(i.spark, bucket, target, log)
    assert set(again.values()) == {0}, again
    loaded = i.spark.read.parquet(f"{target}/raw_summary")
    return loaded.groupBy("collection").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_distinct("_id").alias("ids"))


def _drop_files(df, folder):
    """Compressed JSON-lines files with the ending the ingest looks for.

    Of Spark's text writers only the CSV one lets the ending be chosen; with one column
    and quoting off it writes the lines as they are.
    """
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    (lines.write.mode("append").option("extension", "jsonl").option("quote", "\u0000").option("compression", "gzip")
        .option("maxRecordsPerFile", writers.MAX_DOCUMENTS_PER_FILE)
        .option("sep", "\u0001").csv(folder))


@case("stm3_stream_dedupe", query("""
SELECT DISTINCT order_id, product_id FROM item"""))
def _(i):
    source, target, log = (fresh_path(i.spark, n) for n in ("arrivals", "lines", "stream"))
    i.scrambled_checkouts().write.option("compression", "zstd").parquet(source)
    # Five micro-batches, however many files there are.
    files = len(i.spark.read.schema(schemas.EVENTS).parquet(source).inputFiles())
    arriving = i.spark.readStream.schema(schemas.EVENTS).option("maxFilesPerTrigger", -(-files // 5)).parquet(source)
    stream = dedupe.streaming_cart_lines(arriving)
    (stream.writeStream.format("parquet").option("compression", "zstd").option("path", target).option("checkpointLocation", log)
        .trigger(availableNow=True).start().awaitTermination())
    return i.spark.read.parquet(target).select("order_id", "product_id")


@case("stm3_stream_earliest", query(_CART.rstrip() + " WHERE time_stamp IS NOT NULL"))
def _(i):
    # Files hold the events in scrambled order and micro-batches take some at a time; the rows are those
    # of the batch model.  A last event far ahead moves the watermark past all others.
    source, target, log = (fresh_path(i.spark, n) for n in ("arrivals", "lines", "stream"))
    rows = i.table("lineitem")
    i.scrambled_checkouts().write.option("compression", "zstd").parquet(source)
    arrived = i.spark.read.schema(schemas.EVENTS).parquet(source)
    # Five micro-batches, however many files there are.
    options = {"files": -(-len(arrived.inputFiles()) // 5), "buckets": -(-rows.count() // earliest.KEYS_A_BUCKET)}
    _stream_earliest(i, source, target, log, **options)
    # An event with a cart line: the watermark goes by the lines.
    arrived.where(F.col("cart_products").startswith("[")).limit(1).withColumn(
        "time_stamp", F.lit(4_102_444_800).cast("bigint")).withColumn("_id", F.lit("last")).write.mode("append").parquet(source)
    _stream_earliest(i, source, target, log, **options)
    lines = i.spark.read.parquet(target)
    return lines.where(~F.col("late")).drop("late", "event_timestamp")


def _stream_earliest(i, source, target, log, files, buckets):
    arriving = i.spark.readStream.schema(schemas.EVENTS).option("maxFilesPerTrigger", files).parquet(source)
    stream = earliest.earliest_cart_lines(arriving, i.rates, delay="4000 days", buckets=buckets)
    (stream.writeStream.format("parquet").option("compression", "zstd").option("path", target).option("checkpointLocation", log)
        .trigger(availableNow=True).start().awaitTermination())


# ---- reports -----------------------------------------------------------------------------

_MEASURES = f"count(*) AS line_count, CAST(sum(sales_amount) AS BIGINT) AS units, {cents('total_revenue_usd')} AS revenue_usd"


@case("rpt1_revenue_by_period", query(f"""
SELECT year_number, quarter_number, month_number, {_MEASURES}
FROM mart GROUP BY ROLLUP (year_number, quarter_number, month_number)"""))
def _(i):
    return mart.revenue_by_period(i.mart)


@case("rpt2_revenue_by_place", query(f"""
SELECT location_country_name, location_region_name, location_city_name, {_MEASURES} FROM mart GROUP BY ALL"""))
def _(i):
    return mart.revenue_by_place(i.mart)


@case("rpt3_top_products", query(f"""
SELECT product_id, product_name, {_MEASURES} FROM mart GROUP BY product_id, product_name
ORDER BY revenue_usd DESC, product_id NULLS FIRST LIMIT 20"""))
def _(i):
    return mart.top_products(i.mart, 20)


@case("rpt4_weekend_revenue", query(f"SELECT is_weekend, {_MEASURES} FROM mart GROUP BY is_weekend"))
def _(i):
    return mart.revenue_by_day_type(i.mart)


# ---- data tests --------------------------------------------------------------------------

@case("dq1_not_null", query("SELECT source_event_id FROM cart WHERE order_id IS NULL"))
def _(i):
    return quality.not_null(i.cart, "order_id").select("source_event_id")


@case("dq2_unique", "SELECT l_orderkey, count(*) AS cnt FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1")
def _(i):
    return quality.unique(i.table("lineitem"), "l_orderkey")


@case("dq3_dq4_accepted_values", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
def _(i):
    return quality.accepted_values(i.table("orders"), "o_orderstatus", ["O", "F"]).select("o_orderkey", "o_orderstatus")


@case("dq6_between", """
SELECT l_orderkey, l_quantity, 'inclusive' AS kind FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45
UNION ALL SELECT l_orderkey, l_quantity, 'strict' FROM lineitem WHERE (l_quantity <= 5 OR l_quantity >= 45) AND l_linenumber = 1""")
def _(i):
    lines = i.table("lineitem")
    loose = quality.between(lines, "l_quantity", 5, 45).select("l_orderkey", "l_quantity")
    strict = quality.between(lines, "l_quantity", 5, 45, strictly=True, where="l_linenumber = 1")
    return loose.withColumn("kind", F.lit("inclusive")).unionByName(
        strict.select("l_orderkey", "l_quantity").withColumn("kind", F.lit("strict")))


@case("dq7_matches", """
SELECT page_id FROM pages WHERE page_id % 2 = 0 AND NOT regexp_matches(url, '^https://')""")
def _(i):
    return quality.matches(i.table("pages"), "url", "^https://", where="page_id % 2 = 0").select("page_id")


@case("dq8_length_is", query("""
SELECT location_key, location_country_code FROM dim_loc WHERE location_key <> -1 AND length(location_country_code) <> 2"""))
def _(i):
    return quality.length_is(dims.location(i.models["stg_location"]), "location_country_code", 2,
                             where="location_key <> -1").select("location_key", "location_country_code")


@case("dq9_compound_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(i):
    return quality.duplicate_keys(i.table("lineitem"), ["l_orderkey", "l_linenumber"])


@case("dq10_row_count", "SELECT count(*) AS row_count FROM orders HAVING count(*) < 100 OR count(*) > 1000")
def _(i):
    return quality.row_count_between(i.table("orders"), 100, 1000)


@case("dq11_dq12_contract", query("""
SELECT difference, count(*) AS affected_rows FROM dim_store, (VALUES ('missing column store_domain'),
  ('unexpected column domain'), ('column store_id is string, not bigint')) v(difference) GROUP BY difference"""))
def _(i):
    wrong = dims.store(i.models["stg_store"]).withColumn("store_id", F.col("store_id").cast("string"))
    wrong = wrong.withColumnRenamed("store_domain", "domain")
    found = quality.schema_differences(wrong, schemas.contract("dim_store"))
    rows = wrong.agg(F.count(F.lit(1)).alias("affected_rows"))
    return rows.select(F.explode(F.array(*[F.lit(d) for d in found])).alias("difference"), "affected_rows")


# Every declared test, by kind and model, written down apart from the catalogue the report is built from.
_DECLARED = {
    "not null": "seed currency_symbol currency_code rate_to_usd; stg_checkout_success_cart_items order_id product_id event_timestamp; "
                "stg_products product_id; stg_store store_id; stg_currency currency_code; stg_location ip_address; "
                "dim_date date_key full_date; dim_customer customer_key customer_user_id_db; dim_product product_key; "
                "dim_location location_key; dim_currency currency_key currency_code; dim_store store_key store_id store_domain; "
                "fact_exchange_rate exchange_rate_key date_key currency_key rate_to_usd; fact_sales_order_detail detail_key customer_key "
                "product_key location_key currency_key store_key date_key sales_amount sales_local_price sales_usd_price; "
                "mart_sales_order_detail detail_key",
    "unique": "seed currency_symbol; stg_products product_id; stg_store store_id; dim_date date_key; dim_customer customer_key; "
              "dim_product product_key; dim_location location_key; dim_currency currency_key; dim_store store_key; "
              "fact_exchange_rate exchange_rate_key; fact_sales_order_detail detail_key; mart_sales_order_detail detail_key",
    "between": "dim_date day_of_week month_number quarter_number; dim_product product_base_price product_min_price product_max_price; "
               "fact_exchange_rate rate_to_usd; fact_sales_order_detail sales_amount sales_local_price sales_usd_price; "
               "mart_sales_order_detail total_revenue_usd",
    "accepted": "stg_products product_gender; dim_product product_gender",
    "hashed": "dim_customer customer_email_address",
    "length": "dim_location location_country_code; dim_currency currency_code",
}
_DECLARED_NAMES = [(f"{model} {kind}".replace(" ", f".{column} ", 1), model, kind) for kind, models in _DECLARED.items()
                   for model, *columns in map(str.split, models.split(";")) for column in columns] + [
    *[(f"{m}.{c}_key in dim_{c}", m, "in") for m, cs in (("fact_exchange_rate", "date currency"), (
        "fact_sales_order_detail", "customer location currency store date")) for c in cs.split()],
    ("seed.rate_to_usd above 0", "seed", "above"), ("dim_location place unique", "dim_location", "place unique"),
    ("fact row count", "fact_sales_order_detail", "row count"),
    ("no duplicate order and product", "stg_checkout_success_cart_items", "no duplicate order and product"),
    ("mart has the rows of the fact", "mart_sales_order_detail", "same rows")]


@case("dq_declared_tests", query(f"""
SELECT "check", model, kind, coalesce(failures, 0)::BIGINT AS failures,
       CASE WHEN coalesce(failures, 0) > 0 THEN 'failed' ELSE 'ok' END AS outcome
FROM (VALUES {', '.join(map(str, _DECLARED_NAMES))}) d("check", model, kind) LEFT JOIN (
  SELECT unnest(['stg_checkout_success_cart_items', 'fact_sales_order_detail', 'mart_sales_order_detail'])
           || unnest(['.order_id', '.detail_key', '.detail_key']) || ' not null' AS "check",
         (SELECT count(*) FROM cart WHERE order_id IS NULL) AS failures
  UNION ALL SELECT unnest(['stg_store.store_id', 'dim_store.store_key', 'dim_store.store_id']) || ' not null',
                   (SELECT count(*) FROM store WHERE store_id IS NULL)
  UNION ALL SELECT 'dim_store.store_domain not null', (SELECT count(*) FROM dim_store WHERE store_domain IS NULL)
  UNION ALL SELECT 'dim_location.location_country_code length', (SELECT count(*) FROM dim_loc
                   WHERE location_key <> -1 AND length(location_country_code) <> 2)
  UNION ALL SELECT 'fact row count', (SELECT CASE WHEN count(*) BETWEEN 30000 AND 50000 THEN 0 ELSE 1 END FROM fact)
) USING ("check")"""))
def _(i):
    return warehouse.declared_report(i.spark, i.models, i.rates, saved=False)


@case("jon11_overlapping_ranges", query("""
SELECT CAST((10 * 256 + n) * 65536 + 100 AS BIGINT) AS ip_from, CAST((10 * 256 + n) * 65536 + 199 AS BIGINT) AS ip_to
FROM place WHERE n IN (2, 5)"""))
def _(i):
    inner = i.ip_ranges.where("country_code in (' xc ', ' xf ')").select(
        (F.col("ip_from") + 100).alias("ip_from"), (F.col("ip_from") + 199).alias("ip_to"))
    return iprange.overlapping_ranges(i.ip_ranges.select("ip_from", "ip_to").unionByName(inner))


@case("udf2_layer_names", """
SELECT n_name, CASE WHEN n_nationkey % 2 = 0 THEN 'core.' ELSE 'default.' END || lower(n_name) AS table_name FROM nation""")
def _(i):
    even, odd = (writers.layer_table(layer, "") for layer in (" core ", None))
    prefix = F.when(F.col("n_nationkey") % 2 == 0, even).otherwise(odd)
    return i.table("nation").select("n_name", F.concat(prefix, F.lower("n_name")).alias("table_name"))
