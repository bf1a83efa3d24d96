"""Repeated tracking events in a stream: of each order and product, the earliest line stays.

Unlike `dedupe.streaming_cart_lines`, which passes on the line that arrives first, this gives
the rows of the batch model whatever the order of arrival within the delay.  A line waits
until the watermark has passed its own time: from then on nothing earlier can come in time.
The key is remembered for a while after that, so that repeats are dropped, and then forgotten,
so that state does not grow with the history.

Lines behind the watermark are not lost: one that would have been the earlier choice, or
whose key is not known (any more), is passed on marked as late, for a repair by the batch
merge; one that repeats a known earlier line is dropped.  Lines without a time cannot be
placed and are not read, as in the batch model.

Spark calls the processor for buckets of keys, not for each key: a call takes all lines of a
micro-batch that fall into its bucket and compares them with the bucket's known keys as columns.
What a bucket knows is one compressed Arrow block in its state.  Lines travel and wait as they
come from the cart, as one text each, and are typed when they leave.

State on disk: a block is compressed as a whole, some lines at a time beside each other, so that
what a line repeats of its key and event costs little; each commit of the store is compacted, and
older commits than a restart needs are removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from basketry.plans import staging
from basketry.streaming.state import state_on_disk

DELAY = "3 days"
REMEMBER_DAYS = 3
OUTPUT = "line string, late boolean"
STATE = "block binary"
KNOWN = ["key", "time_stamp", "event", "item", "line", "sent"]
# Calls of the processor cost some 20 ms each; a bucket of some 20,000 keys takes a few MB.
BUCKETS = 256
KEYS_A_BUCKET = 20_000


def earliest_processor(remember_seconds: int) -> StatefulProcessor:
    """The processor; local, so that Spark ships its code and workers need no copy of this package."""

    class Earliest(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.known = handle.getValueState("known", STATE)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            behind = timerValues.getCurrentWatermarkInMs() / 1000
            known = self._read()
            new = pd.concat(list(rows)).sort_values(["time_stamp", "event", "item"])[KNOWN[:-1]]
            new.index = range(len(new))
            old = new[["key"]].merge(known.drop(columns="line"), on="key", how="left")
            first = old.sent.isna()
            waits = old.sent.eq(False) & ~first
            event = old.event.where(~first, "")
            earlier = ~first & ((new.time_stamp < old.time_stamp) | (new.time_stamp == old.time_stamp) & (
                (new.event < event) | (new.event == event) & (new.item < old.item)))
            in_time = new.time_stamp >= behind
            chosen = new[first & in_time | waits & earlier].drop_duplicates("key").assign(sent=False)
            late = new.line[~in_time & (first | ~waits & earlier)]
            if len(chosen):
                kept = known[~known.key.isin(chosen.key)]
                self._write(pd.concat([kept, chosen]) if len(kept) else chosen)
            if len(late):
                yield pd.DataFrame({"line": late, "late": True})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            known = self._read()
            due = self._due(known) * 1000 <= timerValues.getCurrentWatermarkInMs()
            ready = due & ~known.sent
            out = known.line[ready]
            # Of keys that are remembered only their place in the order is kept.
            known = known.assign(sent=known.sent | ready, line=known.line.where(~ready, ""))[ready | ~due]
            self._write(known)
            if len(out):
                yield pd.DataFrame({"line": out, "late": False})

        def _due(self, known: pd.DataFrame) -> pd.Series:
            """When each line is sent, or its key forgotten."""
            return known.time_stamp + 1 + known.sent * remember_seconds

        def _read(self) -> pd.DataFrame:
            state = self.known.get()
            if state is None:
                return pd.DataFrame({"key": pd.Series(dtype=object), "time_stamp": pd.Series(dtype="int64"),
                                     "event": pd.Series(dtype=object), "item": pd.Series(dtype="int64"),
                                     "line": pd.Series(dtype=object), "sent": pd.Series(dtype=bool)})
            size, packed = int.from_bytes(state[0][:8], "big"), state[0][8:]
            with pa.ipc.open_stream(pa.Codec("zstd").decompress(packed, size)) as block:
                return block.read_pandas()

        def _write(self, known: pd.DataFrame) -> None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if known.empty:
                self.known.clear()
                return
            table = pa.Table.from_pandas(known[KNOWN], preserve_index=False)
            block = pa.BufferOutputStream()
            # Columns lie a thousand lines at a time beside each other, within the reach of the codec.
            with pa.ipc.new_stream(block, table.schema) as stream:
                stream.write_table(table, max_chunksize=1000)
            plain = block.getvalue()
            self.known.update((plain.size.to_bytes(8, "big") + pa.Codec("zstd", 3).compress(plain, asbytes=True),))
            self.handle.registerTimer(int(self._due(known).min()) * 1000)

        def close(self) -> None:
            pass

    return Earliest()


def earliest_cart_lines(events: DataFrame, currency_rates: DataFrame, delay: str = DELAY,
                        remember_days: int = REMEMBER_DAYS, buckets: int = BUCKETS) -> DataFrame:
    """Cart lines of a stream of raw events as the batch model has them, and late: whether behind the watermark.

    State lies in RocksDB.  The output is for append mode.  ``buckets`` should grow with the keys that
    are known at a time, about one for ``KEYS_A_BUCKET``; a started stream has to stay with its number.
    """
    state_on_disk(events.sparkSession, rewritten=True)
    lines = staging.packed_lines(events).withColumn("event_timestamp", F.timestamp_seconds("time_stamp"))
    packed = lines.withWatermark("event_timestamp", delay).select(
        F.pmod(F.xxhash64("order_id", "product_id"), F.lit(buckets)).alias("bucket"),
        # Ids are numbers, so no id and a missing one have different texts.
        F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in staging.LINE_KEY]).alias("key"), "time_stamp",
        F.coalesce("source_event_id", F.lit("")).alias("event"), F.col("item_index").cast("bigint").alias("item"), "line")
    kept = packed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=earliest_processor(remember_days * 86400), outputStructType=OUTPUT, outputMode="append",
        timeMode="EventTime")
    typed = staging.unpacked_lines(kept, events, currency_rates)
    return typed.select(*[c for c in typed.columns if c not in ("late", "event_timestamp")], "late", "event_timestamp")
