"""Sources and sinks: data is written below the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from basketry.checks.inputs import Inputs
from basketry.checks.oracle import query
from basketry.checks.registry import case
from basketry.operators import profile
from basketry.plans import catalog, dims, enrichment, staging
from basketry.session import fresh_path
from basketry.sinks import merge, writers
from basketry.sources import readers, schemas


def _jsonl(i: Inputs, df: DataFrame, name: str) -> str:
    path = fresh_path(i.spark, name)
    # A compressed file is read by one task, so it is kept short.
    df.write.option("compression", "gzip").option("maxRecordsPerFile", writers.MAX_DOCUMENTS_PER_FILE).json(path)
    return path


@case("src1_event_scan", query("""
SELECT collection, count(*) AS cnt, count(DISTINCT _id) AS ids, max(time_stamp) AS latest
FROM (SELECT collection, _id, time_stamp FROM browse
      UNION ALL SELECT 'checkout_success', source_event_id, time_stamp FROM ev) GROUP BY collection"""))
def _(i):
    events = readers.read_events(i.spark, _jsonl(i, i.events, "events"))
    return events.groupBy("collection").agg(
        F.count(F.lit(1)).alias("cnt"), F.count_distinct("_id").alias("ids"),
        F.max("time_stamp").alias("latest"))


@case("src2_declared_event_schema", query("""
SELECT _id, CASE WHEN k % 2 = 0 THEN 'ARRAY' ELSE 'OBJECT' END AS option_kind, recommendation,
       product_id FROM browse"""))
def _(i):
    # An extra field and a polymorphic one: the first is dropped, the second becomes a variant.
    path = _jsonl(i, i.browsing.select(
        "_id", "product_id", "recommendation", F.lit(1).alias("not_declared"),
        F.try_parse_json("option").alias("option")), "events")
    events = readers.read_events(i.spark, path, option_type=T.VariantType())
    kind = F.regexp_extract(F.schema_of_variant("option"), "^[A-Z]+", 0)
    return events.select("_id", kind.alias("option_kind"), "recommendation", "product_id")


@case("src3_text_only_products", """
SELECT CASE WHEN p_partkey % 211 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS product_id, p_brand AS sku,
       p_type AS category FROM part""")
def _(i):
    # Ids written as numbers still arrive as text.
    path = _jsonl(i, i.products.withColumn("product_id", F.col("product_id").cast("bigint")), "products")
    return readers.read_products(i.spark, path).select("product_id", "sku", "category")


@case("src4_inferred_locations", query("SELECT ip, raw_code AS country_code, raw_city AS city_name FROM ipl"))
def _(i):
    path = _jsonl(i, i.ip_locations, "ip_location")
    return readers.read_ip_locations(i.spark, path).select("ip", "country_code", "city_name")


@case("src5_src10_named_sources", query("""
SELECT 'raw_summary' AS table_name, (SELECT count(*) FROM ev) + (SELECT count(*) FROM events) AS cnt
UNION ALL SELECT 'raw_ip_location', (SELECT count(*) FROM ipl)
UNION ALL SELECT 'raw_products', (SELECT count(*) FROM part)"""))
def _(i):
    tables = {"raw_summary": i.events, "raw_ip_location": i.ip_locations, "raw_products": i.products}
    registry = readers.Registry(i.spark)
    for name, df in tables.items():
        writers.publish_view(df, name)
        registry.add(f"{name}_count", lambda name=name: registry.source(name).agg(
            F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("table_name"), "cnt"))
    counts = [registry.ref(f"{name}_count") for name in tables]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


@case("src6_currency_seed", query("""
SELECT currency_symbol, CAST(length(currency_symbol) AS BIGINT) AS symbol_length, seed.currency_code,
       currency_name, rate_to_usd, count(source_event_id) AS cart_items
FROM seed LEFT JOIN item ON symbol_no = pos GROUP BY ALL"""))
def _(i):
    path = fresh_path(i.spark, "seed")
    writers.write_csv(i.rates, path)
    seed = readers.read_currency_rates(i.spark, path)
    used = staging.cart_lines(i.events).groupBy(
        F.col("item_currency").alias("currency_symbol")).agg(F.count(F.lit(1)).alias("cart_items"))
    return seed.join(used, "currency_symbol", "left").select(
        "currency_symbol", F.length("currency_symbol").cast("bigint").alias("symbol_length"),
        "currency_code", "currency_name", "rate_to_usd",
        F.coalesce("cart_items", F.lit(0)).alias("cart_items"))


@case("src7_snk6_url_csv", "SELECT CAST(page_id AS VARCHAR) AS product_id, url FROM pages")
def _(i):
    path = fresh_path(i.spark, "urls")
    writers.write_csv(i.table("pages").select(
        F.col("page_id").cast("string").alias("product_id"), "url"), path)
    return readers.read_product_urls(i.spark, path)


@case("src8_done_ids_torn_lines", """
SELECT DISTINCT CAST(page_id % 100 AS VARCHAR) AS product_id FROM pages WHERE page_id % 4 > 1""")
def _(i):
    line = F.to_json(F.struct((F.col("page_id") % 100).cast("string").alias("product_id"), "url"))
    torn = (
        F.when(F.col("page_id") % 4 == 0, F.substring(line, 1, 12))
        .when(F.col("page_id") % 4 == 1, '{"other": 1}').otherwise(line)
    )
    path = fresh_path(i.spark, "done")
    i.table("pages").select(torn.alias("value")).write.text(path)
    return readers.read_done_ids(i.spark, path)


@case("src9_srt1_column_catalog", """
SELECT CAST(row_number() OVER () AS INTEGER) AS ordinal_position, column_name,
       CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
            WHEN 'VARCHAR' THEN 'string' ELSE 'timestamp_ntz' END AS data_type, 'YES' AS is_nullable,
       (SELECT count(*) FROM orders) AS total
FROM (DESCRIBE SELECT * FROM orders)""")
def _(i):
    orders = i.table("orders")
    counted = profile.profile_columns(orders, orders.columns, approximate=True).select(
        F.col("field").alias("column_name"), "total")
    return readers.describe_columns(orders).join(counted, "column_name").orderBy("ordinal_position")


@case("snk1_snk2_export_parts", query("""
SELECT 'summary' AS name, count(*) AS cnt, count(DISTINCT _id) AS ids, true AS parts_fit
FROM (SELECT source_event_id AS _id FROM ev UNION ALL SELECT _id FROM browse)
UNION ALL SELECT 'ip_location', count(*), count(DISTINCT (c_custkey, copy)), true FROM ipl"""))
def _(i):
    tables = {"summary": i.events, "ip_location": i.ip_locations}
    paths = writers.export_all(tables, fresh_path(i.spark, "export"), max_per_file=1000)
    reports = []
    for name, path in paths.items():
        rows = i.spark.read.schema("_id string").json(path).select("_id", "_metadata.file_path")
        per_file = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
        totals = rows.agg(F.count(F.lit(1)).alias("cnt"), F.count_distinct("_id").alias("ids"))
        files = per_file.agg((F.max("n") <= 1000).alias("parts_fit"))
        reports.append(totals.select(F.lit(name).alias("name"), "cnt", "ids").join(
            files.withColumn("name", F.lit(name)), "name"))
    return reports[0].unionByName(reports[1])


@case("snk3_snk5_snk8_append_with_stats", """
SELECT * FROM (VALUES ('first'), ('second')) s(load),
  (SELECT count(*) AS added FROM customer) c, LATERAL (SELECT c.added * CASE load WHEN 'first' THEN 1 ELSE 2 END AS total)""")
def _(i):
    path = fresh_path(i.spark, "append")
    loads = {name: writers.append_rows(i.table("customer"), path) for name in ("first", "second")}
    stats = [F.struct(F.lit(n).alias("load"), F.lit(s.added).cast("bigint").alias("added"),
                      F.lit(s.total).cast("bigint").alias("total")) for n, s in loads.items()]
    counted = i.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.inline(F.array(*stats)))


@case("snk4_snk9_replace", """
SELECT 'append' AS mode, 2 * count(*) AS cnt FROM orders UNION ALL SELECT 'replace', count(*) FROM orders""")
def _(i):
    appended, replaced = fresh_path(i.spark, "a"), fresh_path(i.spark, "r")
    for _ in range(2):
        writers.append_rows(i.table("orders"), appended)
        writers.replace_rows(i.table("orders"), replaced)
    read = i.spark.read.parquet
    count = F.count(F.lit(1)).alias("cnt")
    return read(appended).agg(count).select(F.lit("append").alias("mode"), "cnt").unionAll(
        read(replaced).agg(count).select(F.lit("replace").alias("mode"), "cnt"))


@case("snk7_fixed_column_csv", query("""
SELECT DISTINCT ip, upper(trim(raw_code)) AS country_code FROM (
  SELECT ip, CASE WHEN split_part(ip, '.', 2) = '8' THEN NULL ELSE raw_code END AS raw_code
  FROM (SELECT ip FROM ev UNION ALL SELECT ip FROM browse) LEFT JOIN place ON CAST(split_part(ip, '.', 2) AS INTEGER) = n
  WHERE ip IS NOT NULL)
WHERE raw_code <> '-'"""))
def _(i):
    located, _ = enrichment.full_load(i.events, i.ip_ranges)
    path = fresh_path(i.spark, "ip_csv")
    writers.write_csv(located, path, schemas.IP_LOCATION_COLUMNS)
    back = i.spark.read.option("header", True).csv(path)
    return back.select("ip", F.upper(F.trim("country_code")).alias("country_code"))


@case("snk10_delta_jsonl", query("""
SELECT ip, trim(raw_city) AS city_name FROM ipl
WHERE ip IN (SELECT ip FROM ev UNION ALL SELECT ip FROM browse) AND c_custkey % 2 = 0"""))
def _(i):
    # The warehouse knows every second address, the document store all of them.
    number = F.regexp_extract("_id", r"^l(\d+)-", 1).cast("bigint")
    loaded = i.ip_locations.where(number % 2 == 1)
    delta = enrichment.delta_export(i.events, loaded, i.ip_locations)
    path = fresh_path(i.spark, "delta")
    writers.export_jsonl(delta, path)
    return readers.read_ip_locations(i.spark, path).select("ip", F.trim("city_name").alias("city_name"))


@case("snk11_quarantine", query("""
SELECT ip, CASE WHEN contains(ip, ':') THEN 'ipv6_not_in_ipv4_ranges' ELSE 'invalid_ip_address' END AS error
FROM (SELECT DISTINCT CASE c_custkey % 4 WHEN 0 THEN '::' || c_custkey WHEN 1 THEN '10.0.' || c_custkey
                      ELSE '300.1.1.' || (c_custkey % 256) END AS ip
      FROM customer WHERE c_custkey % 4 <> 3)"""))
def _(i):
    c = F.col("c_custkey")
    text = c.cast("string")
    ip = (
        F.when(c % 4 == 0, F.concat(F.lit("::"), text)).when(c % 4 == 1, F.concat(F.lit("10.0."), text))
        .when(c % 4 == 2, F.concat(F.lit("300.1.1."), (c % 256).cast("string")))
        .otherwise(F.concat(F.lit("10.1.1."), (c % 256).cast("string")))
    )
    good, bad = enrichment.full_load(i.table("customer").select(ip.alias("ip")), i.ip_ranges)
    path = fresh_path(i.spark, "quarantine")
    assert writers.write_quarantine(bad, path, ["ip", "error"])
    return i.spark.read.option("header", True).csv(path)


@case("snk12_success_failure_sinks", query("""
SELECT 'success' AS sink, domain AS what, count(*) AS cnt FROM (
  SELECT arg_min(domain, attempt) AS domain FROM stored WHERE status = 'ok' GROUP BY task_id) GROUP BY domain
UNION ALL
SELECT 'failure', what, count(*) FROM (
  SELECT arg_max(status, attempt) AS what FROM stored GROUP BY task_id
  HAVING count(CASE WHEN status = 'ok' THEN 1 END) = 0) GROUP BY what"""))
def _(i):
    good, bad = catalog.split_outcomes(catalog.parse_pages(i.product_pages))
    good_path, bad_path = fresh_path(i.spark, "good"), fresh_path(i.spark, "bad")
    writers.export_jsonl(good, good_path)
    writers.write_csv(bad, bad_path)
    count = F.count(F.lit(1)).alias("cnt")
    success = readers.read_products(i.spark, good_path).groupBy(F.col("domain_used").alias("what")).agg(count)
    failure = i.spark.read.option("header", True).csv(bad_path).groupBy(F.col("last_error").alias("what")).agg(count)
    return success.select(F.lit("success").alias("sink"), "what", "cnt").unionAll(
        failure.select(F.lit("failure").alias("sink"), "what", "cnt"))


@case("snk13_staging_view", query("SELECT store_key, store_id, store_domain FROM store"))
def _(i):
    return i.spark.table(writers.publish_view(staging.store(i.events), "stg_store"))


@case("snk14_snk16_layered_table", query("SELECT store_key, store_id, store_domain FROM dim_store"))
def _(i):
    # " core " routes to database core, as layer names are trimmed.
    name = writers.save_table(dims.store(staging.store(i.events)), " core ", "dim_store_check",
                              path=fresh_path(i.spark, "dim_store"))
    assert name == "core.dim_store_check" and writers.layer_table(None, "t") == "default.t"
    return i.spark.table(name).drop(*dims.AUDIT)


def _order_versions(i: Inputs) -> tuple[DataFrame, DataFrame]:
    """A target with the orders up to 2000 and a later batch that also corrects some of them."""
    orders = i.table("orders").select(
        F.when(F.col("o_orderkey") % 101 > 0, F.col("o_orderkey")).alias("order_id"),
        (F.col("o_custkey") % 7).alias("product_id"), "o_totalprice",
        F.to_date("o_orderdate").alias("order_date"))
    target = orders.where("order_date < '2000-01-01'")
    batch = orders.where("order_date >= '1999-07-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return target, batch


_MERGED = """
WITH o AS (SELECT CASE WHEN o_orderkey % 101 > 0 THEN o_orderkey END AS order_id, o_custkey % 7 AS product_id,
                  o_totalprice, CAST(o_orderdate AS DATE) AS order_date FROM orders)
SELECT order_id, product_id, o_totalprice + 1 AS o_totalprice, order_date FROM o WHERE order_date >= DATE '1999-07-01'
UNION ALL SELECT * FROM o WHERE order_date < DATE '1999-07-01' OR (order_id IS NULL AND order_date < DATE '2000-01-01')"""


@case("snk15_jon13_merge_table", _MERGED)
def _(i):
    target, batch = _order_versions(i)
    keys = ["order_id", "product_id"]
    name = writers.save_table(target, "core", "merge_check", path=fresh_path(i.spark, "target"))
    merge.merge_into_table(batch, "core", "merge_check", keys, path=fresh_path(i.spark, "merged"))
    return i.spark.table(name)


@case("snk15_merge_partitions", query("""
SELECT order_year, count(*) AS cnt, count(order_id) AS with_id, sum(CASE WHEN changed THEN 1 ELSE 0 END)::BIGINT AS changed
FROM (SELECT CASE WHEN o_orderkey % 101 > 0 THEN o_orderkey END AS order_id,
             CAST(year(o_orderdate) AS BIGINT) AS order_year, o_orderdate >= DATE '1999-07-01' AS changed FROM orders
      UNION ALL SELECT NULL, CAST(year(o_orderdate) AS BIGINT), false FROM orders
      WHERE o_orderkey % 101 = 0 AND o_orderdate >= DATE '1999-07-01' AND o_orderdate < DATE '2000-01-01')
GROUP BY order_year"""))
def _(i):
    target, batch = _order_versions(i)
    path = fresh_path(i.spark, "merge")
    year = F.year("order_date").cast("bigint").alias("order_year")
    old = F.lit(False).alias("changed")
    target.select("*", year, old).write.partitionBy("order_year").parquet(path)
    merge.merge_into_partitions(
        batch.select("*", year, F.lit(True).alias("changed")), path, ["order_id", "product_id"], "order_year")
    return i.spark.read.parquet(path).groupBy(F.col("order_year").cast("bigint").alias("order_year")).agg(
        F.count(F.lit(1)).alias("cnt"), F.count("order_id").alias("with_id"),
        F.count_if("changed").alias("changed"))


@case("snk17_profile_report", """
SELECT 1 AS line, '| field | total | null_count |' AS text UNION ALL SELECT 2, '|---|---|---|'
UNION ALL SELECT 3, '| p_name | ' || count(*) || ' | ' || count(CASE WHEN p_name IS NULL THEN 1 END) || ' |' FROM part""")
def _(i):
    rows = profile.profile_columns(i.table("part"), ["p_name"]).select("field", "total", "null_count")
    lines = writers.markdown_table(rows).splitlines()
    return rows.limit(1).select(F.posexplode(F.array(*[F.lit(t) for t in lines])).alias("line", "text")).select(
        (F.col("line") + 1).alias("line"), "text")
