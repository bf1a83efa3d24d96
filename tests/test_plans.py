"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from basketry.checks.inputs import Inputs
from basketry.operators import iprange, lookup, pick
from basketry.plans import catalog, dims, facts, staging
from basketry.session import cut_lineage


@pytest.fixture(scope="module")
def inputs(spark, folder):
    return Inputs.of(spark, folder)


@pytest.fixture(scope="module")
def stored_events(inputs):
    """Events as the warehouse would find them: a Parquet table."""
    return cut_lineage(inputs.events, "events")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)


def test_filters_and_columns_reach_the_scan(stored_events):
    text = plan(staging.store(stored_events))
    assert "PushedFilters: [IsNotNull(collection)" in text and "EqualTo(collection,checkout_success)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"collection", "store_id", "current_url"}


def test_duplicates_are_dropped_before_the_shuffle(stored_events, inputs):
    text = plan(staging.checkout_cart_items(stored_events, inputs.rates))
    partial, exchange, final = (text.index(x) for x in ("row_number(), 1, Partial", "Exchange hash", "row_number(), 1, Final"))
    assert final < exchange < partial  # plans print from the top
    assert text.count("Exchange hash") == 1
    # each cart is parsed by one generator, each item by one more
    assert text.count("Generate ") == 2


def test_customers_are_combined_before_the_shuffle(stored_events, inputs):
    text = plan(dims.customer(staging.checkout_cart_items(stored_events, inputs.rates)))
    assert "partial_max_by" in text and "partial_min" in text


def test_first_url_is_combined_before_the_shuffle(stored_events):
    text = plan(catalog.product_urls(stored_events))
    assert "partial_min_by" in text and text.count("FileScan parquet") == 1 and "Join" not in text


def test_outcomes_are_split_from_a_written_aggregate(inputs):
    for df in catalog.split_outcomes(catalog.parse_pages(inputs.product_pages)):
        text = plan(df)
        assert "from_json(" not in text and "Exchange" not in text and text.count("FileScan parquet") == 1


def test_known_sizes_make_star_joins_broadcast(inputs):
    text = plan(inputs.mart)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") >= 10


@pytest.mark.parametrize("name", ["fact_exchange_rate", "mart_sales_order_detail"])
def test_no_cross_joins(inputs, name):
    text = plan(inputs.models[name])
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_range_join_pairs_nothing(inputs):
    text = plan(iprange.locate(inputs.browsing, inputs.ip_ranges))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Window" in text


def test_hot_paths_stay_in_the_jvm(inputs):
    for df in (inputs.mart, catalog.parse_pages(inputs.product_pages)):
        assert not re.search("Python|Arrow|Pandas", plan(df))


def test_pages_are_parsed_once(inputs):
    text = plan(catalog.parse_pages(inputs.product_pages))
    assert text.count("from_json(") == 1


def test_a_hot_key_is_split(spark):
    """A third of the fact rows share one key; the join splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        table = spark.range(0, 300_000, 1, 8).select(F.col("id").alias("k"), F.lit("x").alias("attribute"))
        joined = lookup.lookup(rows, table, "k")
        assert joined.where("attribute = 'x'").count() == 300_000
        assert "skew=true" in final_plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_a_hot_duplicate_group_stays_small(spark):
    """Of a key with most of the rows, each map task forwards a single row."""
    rows = spark.range(0, 200_000, 1, 8).select((F.col("id") % 1).alias("k"), "id")
    first = pick.first_per_key(rows, ["k"], [F.asc("id")])
    assert [tuple(r) for r in first.collect()] == [(0, 0)]
    text = plan(first)
    assert "Partial" in text
    written = _shuffle_records(first)
    assert written and max(written) <= 8


def _shuffle_records(df):
    """Records written by each shuffle of an executed plan."""
    df.collect()
    stack, found = [df._jdf.queryExecution().executedPlan()], []
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStage", "BroadcastQueryStage", "ResultQueryStage"):
            stack.append(node.plan())
            continue
        metrics = node.metrics()
        if name == "Exchange" and metrics.contains("shuffleRecordsWritten"):
            found.append(metrics.apply("shuffleRecordsWritten").value())
        children = node.children()
        stack += [children.apply(k) for k in range(children.size())]
    return found


def test_exchange_rates_cover_every_day(inputs):
    days = inputs.models["dim_date"].count()
    codes = inputs.models["dim_currency"].where("currency_key <> -1").count()
    assert inputs.models["fact_exchange_rate"].count() == days * codes
    assert facts.distinct_rates(inputs.rates).count() == 34


def test_a_cart_with_several_lines(spark, inputs):
    """Places in the cart count every entry; of a product listed twice the first entry stays."""
    cart = ('[{"product_id": 5, "amount": 1, "price": "1,00", "currency": "€"}, {"product_id": null, "amount": 2},'
            ' {"product_id": "6", "amount": "3", "price": "2.50", "currency": "$"},'
            ' {"product_id": 5, "amount": 4, "price": "9,00", "currency": "€"}, {"product_id": 7}]')
    rows = [("b", 200, cart, "1.0"), ("a", 100, cart, "1.0"), ("c", 300, cart, "2"), ("d", 300, "[]", "3"), ("e", 300, None, "4")]
    raw = spark.createDataFrame(rows, "_id string, time_stamp long, cart_products string, order_id string")
    columns = {f.name: f.dataType for f in inputs.checkouts.schema.fields}
    events = raw.withColumn("collection", F.lit("checkout_success"))
    events = events.select(*[
        (F.col(n) if n in events.columns else F.lit(None)).cast(t).alias(n) for n, t in columns.items()])
    found = staging.checkout_cart_items(events, inputs.rates).select(
        "order_id", "product_id", "item_index", "source_event_id", "amount", "unit_price")
    assert sorted(map(tuple, found.collect())) == [
        (order, product, index, event, amount, price)
        for order, event in ((1, "a"), (2, "c"))
        for product, index, amount, price in ((5, 0, 1, 1.0), (6, 2, 3, 2.5), (7, 4, None, None))]
