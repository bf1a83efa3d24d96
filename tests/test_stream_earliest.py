"""The stateful stream against the batch model: scrambled batches, ties, repeats, late lines, keys without order."""

import pytest
from pyspark.sql import functions as F

from basketry.plans import staging
from basketry.session import fresh_path
from basketry.sources import schemas
from basketry.sources.readers import bundled_currency_rates
from basketry.streaming import earliest

DAY = 86_400


@pytest.fixture
def stream(spark):
    source, target, log = (fresh_path(spark, n) for n in ("arrivals", "lines", "stream"))
    rates = bundled_currency_rates(spark)
    seen = []

    def events(found):
        rows = [{f.name: None for f in schemas.EVENTS.fields} | {
            "_id": k, "time_stamp": at, "order_id": order, "user_id_db": "12", "collection": "checkout_success",
            "cart_products": f'[{{"product_id": {product}, "amount": 3, "price": "0.10", "currency": "€"}}]'}
            for k, at, order, product in found]
        return spark.createDataFrame([tuple(r[f.name] for f in schemas.EVENTS.fields) for r in rows], schemas.EVENTS)

    def arrive(*found):
        """A micro-batch with these events; returns all lines put out so far, by their event, and whether late."""
        seen.extend(found)
        events(found).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(schemas.EVENTS).parquet(source)
        made = earliest.earliest_cart_lines(arriving, rates, delay="2 days", remember_days=3)
        (made.writeStream.format("parquet").option("path", target).option("checkpointLocation", log)
             .trigger(availableNow=True).start().awaitTermination())
        return {(r["source_event_id"], r["late"]) for r in spark.read.parquet(target).select("source_event_id", "late").collect()}

    arrive.target = target
    arrive.batch_model = lambda: staging.checkout_cart_items(events(seen), rates)
    return arrive


def test_rows_of_the_batch_model_in_any_order(spark, stream):
    assert stream(("b", 10 * DAY + 5, "1.0", 7), ("c", 10 * DAY, "x", 7), ("t", None, "1.0", 7)) == set()
    stream(("a2", 10 * DAY, "1.0", 7), ("d", 11 * DAY, "1.0", 8), ("e", 10 * DAY + 9, "x", 7))
    stream(("a1", 10 * DAY, "1.0", 7), ("f", 11 * DAY - 1, "1.0", 8))
    out = stream(("last", 90 * DAY, "9.0", 1))
    assert out == {("a1", False), ("c", False), ("f", False)}
    made = spark.read.parquet(stream.target).drop("late")
    want = stream.batch_model().where("source_event_id <> 'last'").select(*made.columns)
    assert sorted(map(str, made.collect())) == sorted(map(str, want.collect()))


def test_late_lines_go_aside_and_keys_are_forgotten(stream):
    stream(("a", 10 * DAY, "1.0", 7))
    assert stream(("b", 13 * DAY, "2.0", 7)) == {("a", False)}  # the watermark is day 11
    # A repeat of a known line is dropped; an earlier one and a line of an unknown key are late.
    out = stream(("a9", 10 * DAY + 1, "1.0", 7), ("a0", 9 * DAY, "1.0", 7), ("z", 9 * DAY, "3.0", 7))
    assert out == {("a", False), ("a0", True), ("z", True)}
    # In time again, but still remembered.
    assert stream(("a8", 12 * DAY, "1.0", 7)) == out
    out |= {("b", False)}
    assert stream(("c", 40 * DAY, "4.0", 7)) == out
    # Forgotten by now: the key is new.
    assert stream(("a7", 41 * DAY, "1.0", 7), ("d", 60 * DAY, "5.0", 7)) == out | {("c", False), ("a7", False)}
