"""Suppression of repeated tracking events in a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.functions.numbers import float_text_to_long, to_long
from basketry.plans.staging import cart_lines
from basketry.streaming.state import state_on_disk


def streaming_cart_lines(events: DataFrame, delay: str | None = None) -> DataFrame:
    """Cart lines of a stream of events, each (order, product) once.

    Keeps the line that arrives first, which need not be the earliest by event time as
    in the batch model.  Every key is remembered, so no line is lost however late it comes; keys lie
    in RocksDB, as those of a long history outgrow the executors' memory.
    With a ``delay`` the state is bounded instead: keys are forgotten after it, and lines
    that come later than it are dropped.
    """
    state_on_disk(events.sparkSession, rewritten=False)
    lines = cart_lines(events).select(
        "source_event_id", "item_index", "time_stamp",
        F.timestamp_seconds("time_stamp").alias("event_timestamp"),
        float_text_to_long("order_id").alias("order_id"),
        to_long("item_product_id").alias("product_id"),
    )
    keys = ["order_id", "product_id"]
    if delay is None:
        return lines.dropDuplicates(keys)
    return lines.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(keys)
