"""Versioned tables: atomic commits, snapshots, merges; reports written in order; profiles."""

import os

import pytest
from pyspark.sql import functions as F

from basketry.operators import profile
from basketry.plans import reports
from basketry.session import fresh_path
from basketry.sinks.merge import SchemaChanged
from basketry.sinks.versioned import ConcurrentCommit, VersionedTable

SCHEMA = "k int, v string, day int"


@pytest.fixture
def made(spark):
    t = VersionedTable(spark, fresh_path(spark, "versioned"), "day")
    t.replace(spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 2), (None, "n", 2), (4, "d", None)], SCHEMA))
    return t


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merge_moves_rows_in_one_commit(spark, made):
    batch = spark.createDataFrame([(3, "C", 3), (5, "e", 1), (None, "n", 2), (4, "D", 1)], SCHEMA)
    assert made.merge(batch, ["k"]) == ["1", "2", "3", None]
    want = [(1, "a", 1), (2, "b", 1), (5, "e", 1), (4, "D", 1), (None, "n", 2), (None, "n", 2), (3, "C", 3)]
    assert rows(made.read()) == sorted(want, key=str)  # a null key equals nothing
    assert None not in made.snapshot().folders  # its only row moved away
    assert len(rows(made.read(1))) == 5 and made.versions() == [1, 2]
    assert made.merge(batch.limit(0), ["k"]) == [] and made.versions() == [1, 2]
    with pytest.raises(SchemaChanged):
        made.merge(batch.withColumnRenamed("v", "w"), ["k"])


def test_a_run_that_stops_before_its_commit_changes_nothing(spark, made, monkeypatch):
    before, folders = rows(made.read()), made.snapshot().folders
    batch = spark.createDataFrame([(1, "moved", 9), (3, "c2", 2)], SCHEMA)

    def stop(*_):
        raise KeyboardInterrupt("executor and driver are gone")

    monkeypatch.setattr(made, "_commit", stop)
    with pytest.raises(KeyboardInterrupt):
        made.merge(batch, ["k"])
    again = VersionedTable(spark, made.root, "day")
    assert rows(again.read()) == before and again.snapshot().folders == folders
    assert again.merge(batch, ["k"]) == ["1", "2", "9"]
    assert {r[0]: r[1:] for r in rows(again.read()) if r[0]}[1] == ("moved", 9)
    assert len(again.vacuum(keep=1)) == 1 and again.versions() == [2]  # the orphan; the first version is still in use
    assert len(rows(again.read())) == 5


def test_of_two_writers_from_one_commit_one_fails(spark, made):
    base = made.snapshot()
    made.merge(spark.createDataFrame([(1, "x", 1)], SCHEMA), ["k"])
    with pytest.raises(ConcurrentCommit):
        made._commit(base, base.schema, base.folders)
    assert {r[0]: r[1] for r in rows(made.read())}[1] == "x"
    assert not [f for f in os.listdir(f"{made.root}/_commits") if f.startswith(".") and not f.endswith(".crc")]


def test_readers_keep_their_snapshot(spark, made):
    reader = made.read()
    made.merge(spark.createDataFrame([(1, "x", 2)], SCHEMA), ["k"])
    assert {r["k"]: r["v"] for r in reader.collect()}[1] == "a"


def test_replace_where(spark, made):
    made.replace_where(spark.createDataFrame([(9, "z", 2), (8, "y", 7)], SCHEMA), F.col("day") >= 2)
    assert rows(made.read()) == [(1, "a", 1), (2, "b", 1), (4, "d", None), (8, "y", 7), (9, "z", 2)]
    with pytest.raises(ValueError, match="outside"):
        made.replace_where(spark.createDataFrame([(9, "z", 1)], SCHEMA), F.col("day") >= 2)
    assert "PartitionFilters: [isnotnull(day" in made.read().where("day = 7")._jdf.queryExecution().toString()


def test_publish_and_odd_partition_names(spark):
    t = VersionedTable(spark, fresh_path(spark, "versioned"), "name")
    df = spark.createDataFrame([(1, "a/b=c"), (2, "x y'"), (3, None)], "k int, name string")
    t.replace(df)
    t.merge(spark.createDataFrame([(2, "x y'"), (4, "a/b=c")], "k int, name string"), ["k"])
    assert rows(t.read()) == [(1, "a/b=c"), (2, "x y'"), (3, None), (4, "a/b=c")]
    for _ in range(2):
        name = t.publish("core.versioned_check")
        assert rows(spark.table(name).select("k", "name")) == rows(t.read())
    spark.sql("DROP TABLE core.versioned_check")
    empty = VersionedTable(spark, fresh_path(spark, "versioned"), "name")
    assert empty.snapshot() is None and not empty.exists()
    empty.replace(df.limit(0))
    assert rows(empty.read()) == [] and empty.read().schema == df.schema


def test_reports_are_written_in_order(spark):
    found = spark.createDataFrame([("b", f"p{k:02d}", "int") for k in range(30)] + [("a", "p01", "string"), ("a", "q", "null, object")],
                                  "grp string, path string, types string")
    lines = reports.discovery_report(found)
    path = fresh_path(spark, "reports")
    reports.write_reports(lines.repartition(7), path)
    folder = f"{path}/report=schema_discovery"
    text = "".join(open(f"{folder}/{f}").read() for f in sorted(os.listdir(folder)) if f.startswith("part"))
    assert text.splitlines() == [r["text"] for r in sorted(lines.collect(), key=lambda r: (r["section"], r["line"]))]
    assert "| p01 | int, string |" in text and "### `a` (2 fields)\n\n| Field path | Types |" in text
    assert text.startswith("# Schema discovery\n\n- Groups: **2**\n- Fields of all groups: **31**\n")
    assert text.index("### `a`") < text.index("### `b`") and text.rstrip().endswith("| p29 | int |")


def test_profile_of_all_kinds(spark):
    df = spark.createDataFrame([(1, 0.0, "a", b"\xff", [1]), (1, -0.0, None, b"\xfe", [1]), (None, float("nan"), "", None, None)],
                               "i int, f double, s string, b binary, l array<int>")
    found = {r["field"]: tuple(r)[1:] for r in profile.profile_columns(df, df.columns).collect()}
    assert found == {"i": (3, 1, 33.33, 1), "f": (3, 0, 0.0, 2), "s": (3, 1, 33.33, 2), "b": (3, 1, 33.33, 2), "l": (3, 1, 33.33, 1)}
    assert [tuple(r) for r in profile.profile_columns(df.limit(0), ["i"]).collect()] == [("i", 0, 0, 0.0, 0)]
    plan = profile.profile_columns(df, df.columns)._jdf.queryExecution().toString()
    assert "Expand" not in plan


def test_window_prunes_the_raw_scan_and_leaves_repeats_out(spark):
    import datetime

    from basketry.plans.staged import StagedDays, since_day
    from basketry.sources import schemas
    from basketry.sources.readers import bundled_currency_rates

    day = 86_400

    def events(found):
        plain = [{f.name: None for f in schemas.EVENTS.fields} | {
            "_id": k, "time_stamp": at, "order_id": order, "store_id": "5", "current_url": f"https://{host}/x",
            "collection": "checkout_success",
            "cart_products": f'[{{"product_id": {product}, "amount": 1, "price": "2.00", "currency": "{sign}"}}]',
        } for k, at, order, product, host, sign in found]
        path = fresh_path(spark, "raw")
        spark.createDataFrame([tuple(e[f.name] for f in schemas.EVENTS.fields) for e in plain], schemas.EVENTS).write.parquet(path)
        return spark.read.schema(schemas.EVENTS).parquet(path)

    rates = bundled_currency_rates(spark)
    first = [("a", day, "1.0", 7, "one", "€"), ("b", 40 * day, "2.0", 7, "one", "£"), ("n", day, "x", 9, "one", "€"),
             ("c", 41 * day, "3.0", 8, "one", "€"), ("t", None, "4.0", 8, "one", "€")]
    # Of the later ones, one repeats an old line, one an old line without order, one precedes a line of
    # the window, and one arrives too late.
    later = [("d", 42 * day, "1.0", 7, "two", "$"), ("m", 42 * day, "x", 9, "two", "€"), ("e", 41 * day - 5, "3.0", 8, "two", "€"),
             ("f", 43 * day, "5.0", 8, "two", "€"), ("g", 2 * day, "6.0", 8, "two", "€")]
    staged = StagedDays.below(spark, fresh_path(spark, "staged"))
    staged.load(events(first), rates)
    since = datetime.date(1970, 2, 10)  # day 40
    everything = events(first + later)
    plan = since_day(everything, since)._jdf.queryExecution().toString()
    assert f"GreaterThanOrEqual(time_stamp,{40 * day})" in plan
    staged.load(everything, rates, since)
    staged.load(everything, rates, since)  # the same window again changes nothing
    lines = {r["source_event_id"] for r in staged.cart().collect()}
    assert lines == {"a", "n", "b", "e", "f"}
    visits = {(r["host"], r["cnt"]) for r in staged.visits.read().groupBy("host").sum("cnt").toDF("host", "cnt").collect()}
    assert visits == {("one", 5), ("two", 4)}
    assert {r["currency_symbol"] for r in staged.currency(rates).collect()} == {"€", "£", "$"}
    old = {f for f in staged.cart().inputFiles() if "order_date=1970-01-02" in f}
    assert old and old <= set(staged.lines.read(1).inputFiles())  # the old day was not written again
