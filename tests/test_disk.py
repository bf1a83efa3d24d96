"""What a step leaves on disk while others run."""

import datetime
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from basketry.checks.inputs import Inputs
from basketry.plans import staging, warehouse
from basketry.plans.staged import StagedDays
from basketry.session import fresh_path, shared_root, written_for
from basketry.sinks.versioned import VersionedTable
from basketry.sources import schemas
from basketry.sources.readers import bundled_currency_rates
from basketry.streaming import ingest


@pytest.fixture
def folders(spark):
    """Names of the folders in the shared one that are new since the test began, by what they begin with."""
    def now():
        return set(glob.glob(os.path.join(shared_root(spark).removeprefix("file:"), "*")))

    before = now()
    return lambda name: sorted(f for f in now() - before if os.path.basename(f).startswith(f"{name}-"))


ODD = ['a"b', "back\\slash", "x\ny\tz", "[1,null]", "null", '{"a":"b"}', "ümlaut €", " ", "", None]


def odd_events(spark):
    rows = [{f.name: None for f in schemas.EVENTS.fields} | {
        "_id": f"{n}-{copy}", "time_stamp": 86_400 * n + copy, "order_id": None if n == 3 else f"{n}.0", "collection": "checkout_success",
        "local_time": text, "ip": text, "store_id": text, "user_id_db": text, "email_address": text, "device_id": text, "user_agent": text,
        "cart_products": '[{"product_id": 5, "amount": 2, "price": "1.50", "currency": "a\\"\\\\"}, {"product_id": 6}, {"product_id": "x"}]'}
        for n, text in enumerate(ODD) for copy in (1, 0)]
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.EVENTS.fields) for r in rows], schemas.EVENTS)


def test_whole_lines_are_shuffled_as_texts(spark):
    events, rates = odd_events(spark), bundled_currency_rates(spark)
    plain = staging.checkout_cart_items(events, rates)
    whole = staging.checkout_cart_items(events, rates, whole=True)
    assert whole.schema == plain.schema
    assert sorted(map(str, whole.collect())) == sorted(map(str, plain.collect())) and plain.count() == 3 * len(ODD)
    plan = whole._jdf.queryExecution().optimizedPlan().toString()
    under = plan[plan.index("WindowGroupLimit"):].splitlines()[1]
    assert "AS line#" in under and "AS email_address#" not in under


def test_parsed_carts_go_with_their_last_reader(spark, folder, folders):
    i = Inputs.of(spark, folder)
    models = warehouse.define(spark, i.events, i.ip_locations, i.products, i.rates)
    models[warehouse.CART], models["stg_store"]  # noqa: B018
    assert len(folders(warehouse.CARTS)) == 1
    models["stg_currency"]  # noqa: B018
    assert folders(warehouse.CARTS) == [] and models[warehouse.FLAT].count() > 0


def test_products_are_joined_to_the_fact_before_small_tables(spark, folder):
    plan = Inputs.of(spark, folder).mart._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    named = [next((k for k in ("location_key", "store_key", "currency_key", "date_key", "product_key") if f"({k}#" in j), None) for j in joins]
    assert named[:5] == ["location_key", "store_key", "currency_key", "date_key", "product_key"]  # the outermost first


def test_declared_tests_read_fact_and_mart_written_once(spark, folder, folders):
    report = entry_points.queries()["dq_declared_tests"](spark, folder)
    fact, = folders(warehouse.FACT)
    mart, = folders(warehouse.FLAT)
    assert pq.ParquetDataset(mart).schema.names == ["detail_key", "total_revenue_usd"]
    # No lookup is left in what the tests run.
    assert os.path.exists(fact) and "__key#" not in report._jdf.queryExecution().optimizedPlan().toString()


def test_written_steps_of_one_block_go_at_its_end(spark, folder, folders):
    with written_for(spark.range(5), "once") as rows:
        assert rows.count() == 5 and len(folders("once")) == 1
    with pytest.raises(ZeroDivisionError), written_for(spark.range(5), "once"):
        1 / 0
    assert folders("once") == []
    i, root, day = Inputs.of(spark, folder), fresh_path(spark, "days"), datetime.date(2000, 6, 30)
    staged = StagedDays.below(spark, root)
    staged.load(i.events, i.rates)
    rows = sorted(map(str, staged.cart().collect()))
    staged.load(i.events, i.rates, day)
    assert sorted(map(str, staged.cart().collect())) == rows
    table = VersionedTable(spark, f"{root}/t", "p")
    table.replace(spark.range(9).select("id", (F.col("id") % 3).alias("p")))
    table.merge(spark.range(7, 12).select("id", F.lit(1).cast("bigint").alias("p")), ["id"])
    assert table.read().count() == 12
    assert [folders(name) for name in ("carts", "window", "batch")] == [[], [], []]


def test_ingested_files_are_compressed_well(spark, tmp_path):
    folder = tmp_path / "raw" / "products"
    folder.mkdir(parents=True)
    (folder / "a.jsonl").write_text('{"product_id": "1"}\n')
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")  # whatever the session's default is
    try:
        ingest.ingest_prefix(spark, str(tmp_path), "raw/products/", f"{tmp_path}/t", f"{tmp_path}/c").awaitTermination()
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", codec)
    made, = glob.glob(f"{tmp_path}/t/*.parquet")
    assert pq.ParquetFile(made).metadata.row_group(0).column(0).compression == "ZSTD"


def test_versioned_tables_are_compressed_well(spark):
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")  # whatever the session's default is
    try:
        root = fresh_path(spark, "codec")
        VersionedTable(spark, root, "p").replace(spark.range(9).select("id", F.lit(1).alias("p")))
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", codec)
    made = glob.glob(f"{root.removeprefix('file:')}/data/*/*/*.parquet")
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in made} == {"ZSTD"}
