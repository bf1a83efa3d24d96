"""Operators on small literal tables, with brute force as the judge where it helps."""

import datetime
import ipaddress
import json
import random

import pytest
from pyspark.sql import functions as F

from basketry.functions import numbers
from basketry.operators import discovery, iprange, lookup, pick, profile, quality
from basketry.operators import pages as pages_operator
from basketry.plans import catalog, declared, facts, staging
from basketry.session import cut_lineage, fresh_path, shared_root
from basketry.sinks import merge, writers
from basketry.sources import readers, schemas
from basketry.streaming import ingest


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def event(**fields):
    return {f.name: fields.get(f.name) for f in schemas.EVENTS.fields}


def checkout(order, items, at, **fields):
    return event(**{"_id": f"e{at}", "collection": "checkout_success", "time_stamp": at,
                    "order_id": order, "cart_products": items if isinstance(items, str) else json.dumps(items),
                    **fields})


def events(spark, *documents):
    return spark.createDataFrame(list(documents), schemas.EVENTS)


@pytest.fixture(scope="module")
def rates(spark):
    return readers.bundled_currency_rates(spark)


def test_repeated_events_leave_the_earliest(spark, rates):
    item = [{"product_id": 7, "amount": 1, "price": "1,00", "currency": "€"}]
    raw = events(spark, *[checkout("5050209617.0", item, 1_600_000_000 + 20 * (16 - n)) for n in range(17)])
    kept = staging.checkout_cart_items(raw, rates)
    assert rows(kept, "order_id", "product_id", "time_stamp", "unit_price", "currency_code") == [
        (5050209617, 7, 1_600_000_000, 1.0, "EUR")]


def test_what_a_cart_may_hold(spark, rates):
    raw = events(
        spark,
        checkout("1", "null", 1), checkout("2", '{"product_id":1}', 2), checkout("3", "", 3),
        checkout("4", [{"amount": 1}, {"product_id": "12.0"}, {"product_id": 13}], 4),
        checkout("5", [{"product_id": {"x": 1}}, {"product_id": "{x}"}, 5, None], 5),
        checkout("6", [{"product_id": 1}], 6, collection="checkout"),
        checkout("7", [{"product_id": 1}], None),
    )
    lines = staging.cart_lines(raw)
    assert rows(lines, "order_id", "item_index", "item_product_id") == [
        ("4", 1, "12.0"), ("4", 2, "13"), ("5", 1, "{x}")]


def test_currency_code_agrees_with_the_currency_model(spark, rates):
    carts = [[{"product_id": n, "currency": s}] for n, s in enumerate(["€", " din.", "din.", "??", "", None, "USD $"])]
    raw = events(spark, *[checkout(str(n), c, n + 1) for n, c in enumerate(carts)])
    direct = staging.checkout_cart_items(raw, rates).select("product_id", "currency_code")
    model = staging.currency(raw, rates).select("currency_symbol", F.col("currency_code").alias("code"))
    symbols = staging.cart_lines(raw).select(
        F.col("item_product_id").cast("bigint").alias("product_id"),
        F.nullif("item_currency", F.lit("")).alias("currency_symbol"))
    joined = lookup.lookup(symbols, model, "currency_symbol").select("product_id", "code")
    assert rows(direct) == rows(joined) == [
        (0, "EUR"), (1, "RSD"), (2, "UNK"), (3, "UNK"), (4, None), (5, None), (6, "USD")]


def test_store_ids_are_grouped_after_trimming(spark):
    visits = [(" 7", "https://a.x/1"), ("7", "https://b.x/1"), ("7 ", "https://b.x/2"), (" ", "https://c.x/")]
    raw = events(spark, *[checkout("1", "[]", n, store_id=s, current_url=u) for n, (s, u) in enumerate(visits)])
    assert rows(staging.store(raw), "store_id", "store_domain") == [("7", "b.x"), (None, "c.x")]


def test_bad_product_id_fails_the_run(spark):
    bad = spark.createDataFrame([{c: "x" for c in schemas.PRODUCT_COLUMNS}], schemas.PRODUCTS)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.products(bad).collect()


def test_url_fallback(spark):
    def seen(kind, pid, viewed, url, at):
        return event(_id=f"e{at}", time_stamp=at, collection=kind, product_id=pid, viewing_product_id=viewed,
                     current_url=url, referrer_url=f"ref{at}")

    raw = events(
        spark,
        seen("view_product_detail", None, "1", "u2", 2), seen("view_product_detail", "1", None, "u1", 1),
        seen("view_product_detail", "", "2", "u3", 3), seen("view_listing_page", "3", None, "u4", 4),
        seen("product_view_all_recommend_clicked", None, "1", "u5", 5),
        seen("product_view_all_recommend_clicked", None, "4", "u6", 6),
    )
    assert rows(catalog.product_urls(raw)) == [("1", "u1"), ("4", "ref6")]


def test_range_lookup_against_brute_force(spark):
    rng = random.Random(7)
    cuts = sorted(rng.sample(range(167772160, 167772160 + 400_000), 61))
    ranges = [(a, b - rng.choice([1, 1, 50]), f"c{k}" if k % 7 else "-", "n", "r", f"t{k}")
              for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if k % 5]
    numbers = [rng.randrange(167772160 - 1000, 167772160 + 401_000) for _ in range(3000)]
    numbers += [r[0] for r in ranges] + [r[1] for r in ranges]
    ips = [str(ipaddress.ip_address(n)) for n in numbers]
    expected = set()
    for n, ip in zip(numbers, ips):
        hit = [r for r in ranges if r[0] <= n <= r[1]]
        expected.add((ip, hit[0][5] if hit else "-"))
    table = spark.createDataFrame(ranges, schemas.IP_RANGES)
    frame = spark.createDataFrame([(ip,) for ip in ips + [None, ""]], "ip string")
    found = iprange.locate(frame, table, skip_unknown=False)
    assert set(rows(found, "ip", "city_name")) == expected
    known = iprange.locate(frame, table)
    codes = {r[5]: r[2] for r in ranges}
    assert set(rows(known, "ip", "city_name")) == {e for e in expected if codes.get(e[1], "-") != "-"}
    assert iprange.overlapping_ranges(table).isEmpty()


def test_overlaps_across_blocks_are_reported(spark):
    table = spark.createDataFrame(
        [(0, 200_000, "a", "", "", ""), (150_000, 150_010, "b", "", "", ""), (200_001, 300_000, "c", "", "", "")],
        schemas.IP_RANGES)
    assert rows(iprange.overlapping_ranges(table)) == [(150_000, 150_010)]


def test_merge_twice_changes_nothing_but_unkeyed_rows(spark):
    schema = "order_id bigint, product_id bigint, v int"
    target = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 1, 0)], schema)
    batch = spark.createDataFrame([(2, 1, 5), (3, 1, 5)], schema)
    keys = ["order_id", "product_id"]
    once = merge.merge_by_key(target, batch, keys)
    assert rows(once) == [(1, 1, 0), (2, 1, 5), (3, 1, 5), (None, 1, 0)]
    assert rows(merge.merge_by_key(once, batch, keys)) == rows(once)
    unkeyed = spark.createDataFrame([(None, 1, 9)], schema)
    assert (None, 1, 9) in rows(merge.merge_by_key(once, unkeyed, keys))
    with pytest.raises(merge.SchemaChanged, match="missing column v"):
        merge.merge_by_key(target, batch.drop("v"), keys)


def test_an_interrupted_merge_is_taken_up_again(spark):
    schema = "k bigint, v int"
    writers.save_table(spark.createDataFrame([(1, 0), (2, 0)], schema), "core", "torn")
    spark.sql("ALTER TABLE core.torn RENAME TO core.torn__old")  # stopped between the renames
    merge.merge_into_table(spark.createDataFrame([(2, 5)], schema), "core", "torn", ["k"])
    assert rows(spark.table("core.torn")) == [(1, 0), (2, 5)]
    assert not spark.catalog.tableExists("core.torn__old")


def test_merge_into_a_partitioned_table(spark):
    schema = "order_id bigint, v int, day int"
    put = lambda *r, keys="day": merge.merge_into_partitioned_table(
        spark.createDataFrame(list(r), schema), "core", "by_day", ["order_id"], keys)
    put((1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 0, 1))
    before = set(spark.table("core.by_day").inputFiles())
    put((3, 5, 3), (4, 5, 3), (2, 5, 4), (None, 5, None))  # order 2 moves to another day
    table = spark.table("core.by_day")
    assert rows(table.select("order_id", "v", "day")) == rows(spark.createDataFrame(
        [(1, 0, 1), (2, 5, 4), (3, 5, 3), (4, 5, 3), (None, 0, 1), (None, 5, None)], schema))
    assert {f for f in before if "day=1/" in f} <= set(table.inputFiles())
    with pytest.raises(ValueError, match="partitioned by"):
        put((1, 1, 1), keys="v")


def test_partition_merge_rewrites_touched_partitions_only(spark):
    path = fresh_path(spark, "t")
    schema = "order_id bigint, v int, date_key bigint"
    spark.createDataFrame([(1, 0, 20240101), (2, 0, 20240102), (3, 0, 20240103)], schema).write.partitionBy(
        "date_key").parquet(path)

    def files():
        return [f for f in spark.read.parquet(path).inputFiles() if "date_key=20240103" in f]

    untouched = files()
    # Order 2 moves to another day and leaves its partition empty.
    batch = spark.createDataFrame([(2, 9, 20240101), (4, 9, 20240104)], schema)
    assert merge.merge_into_partitions(batch, path, ["order_id"], "date_key") == [20240101, 20240102, 20240104]
    after = spark.read.parquet(path)
    assert rows(after, "order_id", "v", "date_key") == [
        (1, 0, 20240101), (2, 9, 20240101), (3, 0, 20240103), (4, 9, 20240104)]
    assert len(untouched) == 1 and files() == untouched


def test_partition_merge_keeps_rows_without_partition_value(spark):
    path = fresh_path(spark, "t")
    schema = "order_id bigint, v string, date_key bigint"
    spark.createDataFrame([(1, "a", None), (2, "b", 20240101), (3, "c", None)], schema).write.partitionBy(
        "date_key").parquet(path)
    batch = spark.createDataFrame([(9, "new", None), (3, "d", 20240101)], schema)
    assert set(merge.merge_into_partitions(batch, path, ["order_id"], "date_key")) == {None, 20240101}
    after = {tuple(r) for r in spark.read.parquet(path).select("order_id", "v", "date_key").collect()}
    assert after == {(1, "a", None), (2, "b", 20240101), (3, "d", 20240101), (9, "new", None)}


def test_ingest_fails_on_malformed_lines(spark, tmp_path):
    prefix = next(p for p, table in readers.PATH_TABLES.items() if table == "raw_summary")
    folder = tmp_path / prefix
    folder.mkdir(parents=True)
    (folder / "x.jsonl").write_text('{"_id": "1", "time_stamp": 5}\nnot json at all\n')
    with pytest.raises(Exception, match="(?i)malformed|failed"):
        ingest.ingest_prefix(spark, str(tmp_path), prefix, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    assert ingest.table_rows(spark, str(tmp_path / "nowhere")) == 0


def test_usd_price_of_odd_prices_and_rates(spark):
    frame = spark.createDataFrame([(9999999999999999999.0, 1.0), (1e6, 0.00003912), (1e6, 0.0000004), (None, None), (1e300, 1.0)],
                                  "p double, r double")
    got = [r[0] for r in frame.select(numbers.usd_price("p", "r").cast("double")).collect()]
    assert got == [1e19, 39.12, 0.4, 0.0, None]


def test_pages_with_empty_maps_keep_their_product(spark):
    page = '<script>var react_data = {"product_id": 5, "name": "Ring", "gender": %s, "attributes": %s};</script>'
    pages = [(g, a, page % (g, a)) for g, a in (
        ('"Men"', "[]"), ("false", '{"gender": {"value": "Women"}}'), ('""', '{"gender": []}'), ('"Kids"', "false"))]
    stored = pages_operator.with_product_data(spark.createDataFrame(pages, "g string, a string, html string"))
    record = pages_operator.product_record(F.col("data"), F.lit("1"), F.lit("u"), F.lit("d"))
    got = [(r["name"], r["gender"]) for r in stored.select(*record).collect()]
    assert got == [("Ring", "Men"), ("Ring", "Women"), ("Ring", None), ("Ring", "Kids")]


def test_report_is_never_cut(spark):
    with pytest.raises(ValueError):
        writers.markdown_table(spark.range(5), limit=4)
    assert len(writers.markdown_table(spark.range(5), limit=5).splitlines()) == 7


def test_document_paths(spark):
    document = {"a": [{"b": 1}, {"c": 2}], "d": None, "e": True, "f": [], "g": [[1]], "h": {"i": 1.5}}
    texts = [("x", json.dumps(document)), ("y", '{"a": "tail"'), ("y", None), ("z", "[[1], 2]"), ("z", '{"q \\" [[{": {}}'), ("z", "7"),
             ("y", '{"a": 1, "a": 2}')]
    frame = spark.createDataFrame(texts, "k string, doc string")
    assert discovery.nesting_depth(frame.where("k <> 'y'"), "doc") == 3
    got = sorted(rows(discovery.document_paths(frame, "k", "doc")))
    assert got == sorted([("x", *pair) for pair in [
        ("a", "array"), ("a[]", "object"), ("a[].b", "int"), ("d", "null"), ("e", "bool"), ("f", "array"),
        ("g", "array"), ("g[]", "array"), ("h", "object"), ("h.i", "float")]] + [("z", "[]", "array"), ("z", 'q " [[{', "object")])
    assert rows(discovery.broken_documents(frame, "doc")) == [texts[1], texts[6]]
    assert discovery.document_paths(frame.limit(0), "k", "doc").count() == 0


def test_declared_tests_that_were_not_run_show(spark):
    tests = [t for t in declared.catalogue() if t.model in ("seed", "dim_store")]
    seed = spark.createDataFrame([("a", "EUR", 1.0), ("a", None, 0.0)], "currency_symbol string, currency_code string, rate_to_usd double")
    found = {r["check"]: (r["failures"], r["outcome"]) for r in declared.with_outcome(
        spark, tests, declared.measure(tests, {"seed": seed})).collect()}
    assert len(found) == len(tests) == 9 and found["dim_store.store_key unique"] == (None, "not run")
    assert found["seed.currency_symbol unique"] == (1, "failed") and found["seed.currency_code not null"] == (1, "failed")
    assert found["seed.rate_to_usd above 0"] == (1, "failed") and found["seed.currency_symbol not null"] == (0, "ok")


def test_attempts_put_the_own_domain_first(spark):
    ranked = F.array(*[F.lit(d) for d in "abcdef"])
    frame = spark.createDataFrame([("c",), ("z",)], "domain string")
    got = frame.select("domain", catalog.attempt_domains("domain", ranked)).collect()
    assert {d: list(a) for d, a in got} == {"c": list("cabde"), "z": list("zabcd")}


def test_look_back_window(spark):
    frame = spark.createDataFrame([(datetime.date(2024, 1, d),) for d in range(1, 8)], "order_date date")
    assert facts.recent(frame, datetime.date(2024, 1, 7)).count() == 4


def test_data_tests(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "bb"), (None, "a"), (3, None)], "k int, t string")
    assert quality.not_null(frame, "k").count() == 1
    assert rows(quality.unique(frame, "k")) == [(1, 2)]
    assert quality.accepted_values(frame, "t", ["a"]).count() == 1
    assert quality.between(frame, "k", 1, 3).count() == 0
    assert quality.between(frame, "k", 1, 3, strictly=True).count() == 3
    assert quality.matches(frame, "t", "^a$", where="k is not null").count() == 1
    assert quality.length_is(frame, "t", 1).count() == 1
    assert quality.relationship(frame, "k", frame.where("k = 1"), "k").count() == 1
    assert quality.row_count_between(frame, 4, 4).isEmpty()
    assert rows(quality.row_count_between(frame, 5, 9)) == [(4,)]
    assert quality.same_row_count(frame, frame, "a", "b").isEmpty()
    assert rows(quality.same_row_count(frame, frame.where("k = 1"), "a", "b")) == [(4, 2)]
    with pytest.raises(quality.ContractBroken, match="store_key"):
        quality.enforce_contract(frame, "dim_store")


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b int")
    assert rows(profile.profile_columns(empty, ["a", "b"])) == [("a", 0, 0, 0.0, 0), ("b", 0, 0, 0.0, 0)]
    odd = spark.createDataFrame([("1",), ("1.5",), ("x",), (None,)], "t string")
    assert rows(profile.count_uncastable(odd, "t")) == [(2,)]


def test_seed_keeps_odd_symbols(spark, rates):
    path = fresh_path(spark, "seed")
    writers.write_csv(rates, path)
    back = readers.read_currency_rates(spark, path)
    assert rows(back) == rows(rates) and back.count() == 35
    symbols = {r[0] for r in back.select("currency_symbol").collect()}
    assert {" din.", "￥", "د.ك.‏"} <= symbols


def test_empty_csv_keeps_its_header(spark):
    path = fresh_path(spark, "empty")
    writers.write_csv(spark.createDataFrame([], "ip string, x int"), path, ["ip"])
    assert spark.read.option("header", True).csv(path).columns == ["ip"]
    assert not writers.write_quarantine(spark.createDataFrame([], "ip string, error string"), path + "q", ["ip"])


def test_unknown_fields_are_dropped_and_bad_lines_fail(spark):
    path = fresh_path(spark, "events")
    spark.createDataFrame([('{"_id":"a","order_id":5.0,"new":1,"cart_products":[{"p":1.0}]}',)], "v string").write.text(path)
    got = readers.read_events(spark, path).first()
    assert (got["order_id"], got["cart_products"]) == ("5.0", '[{"p":1.0}]') and "new" not in got
    spark.createDataFrame([('{"_id": ',)], "v string").write.mode("append").text(path)
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        readers.read_events(spark, path).collect()


def test_file_routing():
    assert readers.table_for_path("raw/summary/x.jsonl") == "raw_summary"
    assert readers.table_for_path("raw/other/x.jsonl") is None
    assert readers.table_for_path("raw/summary/x.pdf") is None


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = fresh_path(spark, "probe")
    assert path.startswith(named or shared_root(spark))
    kept = cut_lineage(spark.range(3), "probe")
    assert kept.count() == 3 and all(shared_root(spark) in f for f in kept.inputFiles())


def test_first_n_per_key(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    assert rows(pick.first_n_per_key(frame, ["k"], [F.asc("id")], 2)) == [
        (0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]


def test_best_source_reads_each_side_once(spark):
    from basketry.operators import lookup

    a = spark.createDataFrame([(1, "a", 5), (1, "a", 3), (None, "a", 1)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "b", 0), (2, "b", 9), (2, "b", None), (None, "b", 0)], "k int, s string, n int")
    made = {tuple(r) for r in lookup.best_source([a, b], "k").collect()}
    assert made == {(1, "a", 3), (2, "b", None), (None, "a", 1)}
    assert lookup.best_source([a.limit(0), b.limit(0)], "k").collect() == []


def test_every_pair_takes_short_lists_only(spark):
    rows = spark.range(2).withColumnRenamed("id", "n")
    some = spark.range(lookup.SHORT_LIST).select(F.col("id").alias("item"))
    assert lookup.every_pair(rows, some).count() == 2 * lookup.SHORT_LIST
    assert lookup.every_pair(rows, some.limit(0)).count() == 0
    with pytest.raises(Exception, match="more than 1000 items"):
        lookup.every_pair(rows, spark.range(lookup.SHORT_LIST + 1).select(F.col("id").alias("item"))).collect()
