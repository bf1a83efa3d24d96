"""Steps whose work must not grow faster than their input."""

import glob
import hashlib
import os
import time

import pandas as pd
import pyarrow.parquet as pq

import __spark_entry__ as entry_points
from basketry.checks.inputs import Inputs
from basketry.plans import facts, staging, warehouse
from basketry.session import shared_root
from basketry.streaming.earliest import earliest_cart_lines, earliest_processor


class Handle:
    """What the processor sees of Spark: one value and the timers of one group."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0
        self.getValueState = lambda name, schema: self
        self.listTimers = lambda: list(self.timers)
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.discard

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.value = None


class Times:
    def __init__(self, seconds):
        self.getCurrentWatermarkInMs = lambda: seconds * 1000


def test_stream_keeps_many_keys_in_one_call():
    handle, processor = Handle(), earliest_processor(100)
    processor.init(handle)

    def put(watermark, *rows):
        frame = pd.DataFrame(rows, columns=["key", "time_stamp", "event", "item", "line"]).assign(bucket=0)
        cut = len(frame) // 2
        return [tuple(r) for f in processor.handleInputRows((0,), iter([frame[:cut], frame[cut:]]), Times(watermark)) for r in f.values]

    def expire(watermark):
        return [tuple(r) for f in processor.handleExpiredTimer((0,), Times(watermark), None) for r in f.values]

    n = 500
    assert put(0, *[(f"k{k}", 50 + copy, "b", 0, f"{k}-{copy}") for copy in (1, 0) for k in range(n)]) == []
    assert handle.calls == 2 and handle.timers == {51_000}
    # An earlier event, an earlier item, the same line again, and one behind the watermark that is still the first.
    assert put(20, ("k0", 50, "a", 0, "event"), ("k1", 50, "b", -1, "item"), ("k2", 50, "b", 0, "again"), ("k3", 10, "z", 0, "first")) == []
    assert handle.timers == {11_000}
    assert put(20, ("new", 10, "a", 0, "late")) == [("late", True)]
    assert expire(20) == [("first", False)]
    assert sorted(expire(60)) == sorted([("event", False), ("item", False)] + [(f"{k}-0", False) for k in [2, *range(4, n)]])
    # Sent keys are remembered, then forgotten: only an earlier line is late, then any.
    assert put(60, ("k5", 51, "b", 0, "repeat"), ("k6", 49, "b", 0, "earlier")) == [("earlier", True)]
    assert expire(200) == [] and handle.value is None and not handle.timers
    assert put(200, ("k5", 51, "b", 0, "unknown")) == [("unknown", True)]


def test_state_holds_what_a_line_repeats_once():
    handle, processor = Handle(), earliest_processor(100)
    processor.init(handle)
    ids = [hashlib.md5(str(n).encode()).hexdigest() for n in range(4000)]
    rows = [(k[:16], 50, k[16:], 0, f'["{k[16:]}","{k[:16]}"]') for k in ids]
    assert list(processor.handleInputRows((0,), iter([pd.DataFrame(rows, columns=["key", "time_stamp", "event", "item", "line"])]), Times(0))) == []
    assert len(handle.value[0]) < 33 * len(rows)  # the ids of a line alone are 16 bytes
    out, = processor.handleExpiredTimer((0,), Times(60), None)
    assert sorted(out.line) == sorted(r[4] for r in rows)


def test_old_state_does_not_pile_up(spark, folder):
    inputs = Inputs.of(spark, folder)
    earliest_cart_lines(inputs.events, inputs.rates)
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "2"
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.compactOnCommit") == "true"


def test_keys_of_the_stream_lie_on_disk(spark, folder):
    queries = entry_points.queries()
    queries["stm3_stream_dedupe"](spark, folder)
    newest = max(glob.glob(os.path.join(shared_root(spark).removeprefix("file:"), "stream-*")), key=os.path.getmtime)
    names = [f for _, _, files in os.walk(f"{newest}/state") for f in files]
    assert any(n.endswith(".zip") for n in names) and not any(n.endswith((".delta", ".snapshot")) for n in names)
    arrived = max(glob.glob(os.path.join(shared_root(spark).removeprefix("file:"), "arrivals-*")), key=os.path.getmtime)
    assert {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in glob.glob(f"{arrived}/*.parquet")} == {"ZSTD"}


def test_shuffle_files_go_with_the_query(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return sorted(x for x in str(disk.getAllFiles().mkString(" ")).split() if "/shuffle_" in x)

    before = shuffles()
    spark.range(5000).repartition(5, "id").write.format("noop").mode("overwrite").save()
    until = time.time() + 20
    while set(shuffles()) - set(before) and time.time() < until:
        time.sleep(0.2)
    assert not set(shuffles()) - set(before)
    # What is run twice gives the same rows twice.
    rows = spark.range(5000).groupBy("id").count().where("count = 1")
    assert len(rows.collect()) == len(rows.collect()) == rows.count() == 5000


def test_scrambled_checkouts_are_dealt_before_they_are_built(spark, folder):
    inputs = Inputs.of(spark, folder)
    made = inputs.scrambled_checkouts()
    assert made.count() == inputs.checkouts.count() and made.exceptAll(inputs.checkouts).isEmpty()
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    dealt = plan[plan.index("RepartitionByExpression [l_orderkey"):]
    assert "cart_products" in plan and "cart_products" not in dealt and "checkout_success" not in dealt


def test_carts_are_not_parsed_in_the_scan_as_well(spark, folder):
    lines = staging.cart_lines(Inputs.of(spark, folder).checkouts)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" in plan
    assert not [line for line in plan.splitlines() if "Filter" in line and "from_json" in line]


def test_pieces_stay_small(spark):
    assert Inputs(spark, "").pieces(spark.range(10_000_000)) >= 40


def test_incremental_fact_writes_only_what_the_fact_needs_of_the_lines(spark, folder):
    def written():
        return set(glob.glob(os.path.join(shared_root(spark).removeprefix("file:"), f"{warehouse.CART}-*")))

    before = written()
    entry_points.queries()["mod13_snk15_incremental_fact"](spark, folder)
    made, = written() - before
    assert pq.ParquetDataset(made).schema.names == facts.CART_COLUMNS
