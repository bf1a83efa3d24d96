"""Carts parsed once: the same fields as an element at a time, and the models that share them."""

import glob
import gzip
import json
import os

from pyspark.sql import functions as F

from basketry.checks import cases, inputs
from basketry.functions import jsontext
from basketry.plans import staging, warehouse
from basketry.session import shared_root
from basketry.sinks import writers
from basketry.sources import readers, schemas
from basketry.sources.readers import bundled_currency_rates
from basketry.streaming import ingest

NAMES = ["product_id", "price"]
CARTS = [
    '[{"product_id":1,"price":"1.50","option":[{"a":"x"}]},{"product_id":12.0}]', '[1,{"product_id":2}]', '[null,{"product_id":2}]',
    '["x",{"product_id":2}]', '[{"product_id":{"a":1},"price":"{\\"a\\":1}"},{"product_id":"[2]"}]', '[{"product_id":"\\u005b2"}]',
    '[{"product_id":1},{"product_id":2', '{"product_id":1}', " [{\"product_id\":5}]", "[]", "", "null", None, '[{"product_id":1,"product_id":3}] x',
    '[[{"product_id":7}]]', '[{"price":1E3,"product_id":true}]', "[{'product_id':'[1]'}]"]


def test_items_fields_are_those_of_each_element(spark):
    rows = spark.createDataFrame(list(enumerate(CARTS)), "n int, cart string")
    one = rows.select("n", F.posexplode(jsontext.items_fields("cart", NAMES)).alias("i", "f")).select("n", "i", "f.*")
    texts = rows.select("n", F.posexplode(jsontext.array_items("cart")).alias("i", "item")).select(
        "n", "i", "item", jsontext.once(jsontext.fields("item", NAMES)).alias("parsed"))
    each = texts.select("n", "i", *[jsontext.scalar_field("parsed", "item", f).alias(f) for f in NAMES])
    assert sorted(map(str, one.collect())) == sorted(map(str, each.collect()))
    assert one.where("product_id is not null").count() > 8


def test_models_read_the_raw_events_once(spark):
    rows = [{f.name: None for f in schemas.EVENTS.fields} | {
        "_id": str(n), "time_stamp": n, "order_id": "1.0", "collection": "checkout_success", "store_id": " 7", "current_url": url,
        "cart_products": '[{"product_id": 5, "price": "1", "currency": "€"}]'} for n, url in enumerate(["https://a.b/x", "", None])]
    events = spark.createDataFrame([tuple(r[f.name] for f in schemas.EVENTS.fields) for r in rows], schemas.EVENTS)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    models = warehouse.define(spark, events.mapInArrow(count, events.schema), None, None, bundled_currency_rates(spark))
    assert [r["store_domain"] for r in models["stg_store"].collect()] == ["a.b"]
    assert models["stg_currency"].count() == models[warehouse.CART].count() == 1
    assert seen.value == len(rows)
    assert staging.store_visits(events).where("host is null").first()["cnt"] == 1


def test_pieces_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr(inputs, "ROWS_A_PIECE", 10)
    assert inputs.Inputs(spark, "").spread(spark.range(95), "id").rdd.getNumPartitions() == 10


def test_exported_parts_are_compressed(spark, tmp_path):
    rows = spark.range(2000).selectExpr("cast(id as string) as _id", "cast(null as string) as empty")
    writers.export_jsonl(rows, f"{tmp_path}/out", max_per_file=600)
    parts = sorted((tmp_path / "out").glob("part-*"))
    assert len(parts) >= 4 and sum(p.stat().st_size for p in parts) * 3 < sum(len(f'{{"_id":"{n}","empty":null}}\n') for n in range(2000))
    assert spark.read.schema(rows.schema).json(f"{tmp_path}/out").exceptAll(rows).isEmpty()
    assert json.loads(gzip.open(parts[0]).readline()) == {"_id": "0", "empty": None}


def test_compressed_files_are_ingested(spark, tmp_path):
    folder = tmp_path / "raw" / "products"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text('{"product_id": "1"}\n')
    (folder / "b.jsonl.gz").write_bytes(gzip.compress(b'{"product_id": "2"}\n'))
    (folder / "c.json.gz").write_bytes(gzip.compress(b'{"product_id": "3"}\n'))
    ingest.ingest_prefix(spark, str(tmp_path), "raw/products/", f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(f"{tmp_path}/t").select("product_id").collect()) == ["1", "2"]
    assert readers.table_for_path("raw/products/b.jsonl.gz") == "raw_products"


def test_arrivals_of_the_stream_are_dealt_into_pieces(spark, folder, monkeypatch):
    monkeypatch.setattr(inputs, "ROWS_A_PIECE", 500)
    cases()["stm3_stream_dedupe"].run(inputs.Inputs.of(spark, folder))
    newest = max(glob.glob(f"{shared_root(spark)}/arrivals-*"), key=os.path.getmtime)
    assert len(spark.read.parquet(newest).inputFiles()) >= 12


def test_cart_texts_are_those_of_to_json(spark):
    price, symbol = "1,234.50", 'a"\\€'
    rows = spark.createDataFrame([(True, 5, 2, price, 0), (False, 5, 2, price, 0), (False, None, None, None, 1), (None, 5, 2, price, None)],
                                 "first boolean, product bigint, amount int, price string, place int")
    currency = F.get(F.array(F.lit(inputs._member("currency", symbol)), F.lit(inputs._member("currency", None))), F.col("place"))
    kind = "struct<product_id:bigint,amount:int,price:string,currency:string,option:array<struct<option_id:int,option_label:string>>>"
    option = F.array(F.struct(F.lit(7).alias("option_id"), F.lit('a "quoted" {label}').alias("option_label")))
    item = F.struct("product", "amount", "price", F.when(F.col("place") == 0, symbol), option).cast(kind)
    other = F.struct(F.lit(None), F.lit(1), F.lit("5.00"), F.lit("€"), F.lit(None)).cast(kind)
    made = rows.select(
        inputs._cart_text(F.col("first"), F.col("product"), F.col("amount"), F.col("price"), currency).alias("text"),
        F.to_json(F.when(F.col("first"), F.array(item, other)).otherwise(F.array(other, item))).alias("json")).collect()
    assert [r["text"] for r in made] == [r["json"] for r in made]


def test_places_are_cleaned_in_pieces(spark, folder, monkeypatch):
    monkeypatch.setattr(inputs, "ROWS_A_PIECE", 10)
    raw = inputs.Inputs(spark, folder)
    assert raw.ip_locations.rdd.getNumPartitions() == raw.pieces(raw.table("customer")) > 8


def test_lines_of_one_use_are_not_written(spark, folder):
    def written():
        return len(glob.glob(f"{shared_root(spark)}/{warehouse.CART}-*"))

    before = written()
    for name in ("jon5_every_pair", "set1_unknown_members", "mth2_line_revenue", "cmp6_unknown_fallback"):
        cases()[name].run(inputs.Inputs.of(spark, folder)).schema
    assert written() == before


def test_shuffles_of_large_tables_begin_with_many_partitions(spark):
    rows = spark.range(20).groupBy(F.col("id") % 7).count()
    assert "192)" in rows._jdf.queryExecution().executedPlan().toString()
