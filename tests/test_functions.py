"""Literal rows for the column functions."""

import datetime
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from basketry.functions import business, dates, jsontext, keys, numbers, text
from basketry.operators import iprange, pages


@pytest.mark.parametrize("written, price", [
    ("2.962,00", 2962.0), ("1,094.00", 1094.0), ("1.185", 1185.0), ("0.125", 125.0), ("12,5", 12.5),
    ("1.5", 1.5), ("99", 99.0), ("1.234.567,89", 1234567.89), ("1,234,567", 1234567.0),
    ("1 094,00", None), ("1'234.00", None), ("abc", None), ("", None), ("  ", None), (None, None),
    ("12,", 12.0), (".5", 0.5), ("1,234,56", None), ("1.234.56", None), ("-1.234,5", -1234.5),
    ("12d", None), ("0x1p3", None), (" 12.5 ", 12.5), ("1,000", 1000.0), ("12,34.567", 1234567.0),
])
def test_parse_price(values, written, price):
    assert values(numbers.parse_price, [written]) == [price]


def test_order_id_from_float_text(values):
    assert values(numbers.float_text_to_long, ["3251020421.0", "x", "2.5", "-2.5", None, "1e3"]) == [
        3251020421, None, 3, -3, None, 1000]


def test_safe_casts(values):
    assert values(numbers.to_long, ["12", "1.5", "", "x", None]) == [12, None, None, None, None]
    assert values(numbers.to_double, ["1.5", "12d", "NaN", "Infinity", " +.5e1 "]) == [1.5, None, None, None, 5.0]


def test_trim_knows_all_white_space(values):
    assert values(text.strip_space, [" a b ", " \t x　\n", " ", ""]) == ["a b", "x", "", ""]
    assert values(text.blank_to_null, ["  ", " y ", None]) == [None, "y", None]


def test_capitalize_words(values):
    assert values(text.capitalize_words, [
        "saint-denis o'neil", "nEW   york", "a/b(c)[d]", "tab\tseparated", "x_y.z", None, ""]) == [
        "Saint-Denis O'neil", "New   York", "A/B(C)[D]", "Tab\tSeparated", "X_Y.Z", None, ""]


def test_last_position(values):
    assert values(lambda c: text.last_position(c, ","), ["a,b,c", "abc", ",", ""]) == [4, 0, 1, 0]


def test_url_host(values):
    assert values(text.url_host, [
        "https://user:pw@www.shop.com:8443/x?y#z", "//h/p", "bare.host/path", " http://a.b?q=1 ",
        "/path", "http://a b|c/x", "mailto:me@x", None, ""]) == [
        "www.shop.com", "h", "bare.host", "a.b", None, "a b|c", "x", None, None]


def test_url_authority(values):
    assert values(text.url_authority, ["https://me@a.b:81/x", "no scheme", "//h/p"]) == ["me@a.b:81", "", "h"]


def test_meta_content(values):
    html = '<html><META content=\' A "b" \' property="og:title"><meta name="x" content="n"></html>'
    assert values(lambda c: text.meta_content(c, "og:title"), [html, "<p>", None]) == ['A "b"', None, None]
    assert values(lambda c: text.meta_content(c, "x", "name"), [html]) == ["n"]


def test_surrogate_key(values):
    expected = int(hashlib.md5(b"abc").hexdigest()[:15], 16)
    assert values(keys.surrogate_key, ["abc", None]) == [expected, None]


def test_masked_email(values):
    one, other, none = values(keys.mask_email, [" A@b.c ", "a@B.C", None])
    assert one == other == hashlib.sha256(b"a@b.c").hexdigest() and none is None


def test_gender(values):
    assert values(business.gender_group, [
        " Women ", "женски", "men", "çocuk", "male", "", None, "Kadın"]) == [
        "Female", "Female", "Male", "Kids", "Unknown", "Unknown", "Unknown", "Female"]


def test_location(spark, values):
    assert values(business.country_code, ["usa", " us ", "-", None]) == ["UNK", "US", "UNK", "UNK"]
    assert values(business.place_name, ["-", "Invalid IP", "x missing y", " saint-denis ", ""]) == [
        "UNK", "UNK", "UNK", "Saint-Denis", "UNK"]
    key = business.location_key(F.lit("UNK"), F.lit("UNK"), F.lit("UNK"))
    known = business.location_key(F.lit("UNK"), F.lit("UNK"), F.lit("Paris"))
    assert spark.range(1).select(key, known > 0).first()[:] == (-1, True)


def test_calendar(values):
    days = [datetime.date(2021, 1, 1), datetime.date(2021, 1, 3), datetime.date(2024, 12, 31)]
    assert values(dates.sunday_week, days, "date") == [0, 1, 52]
    assert values(dates.date_key, days, "date") == [20210101, 20210103, 20241231]
    assert values(dates.is_weekend, days, "date") == [False, True, False]


def test_days_do_not_depend_on_the_session_zone(spark, values):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        assert values(dates.utc_date, [0, 86399, 86400, -1], "bigint") == [
            datetime.date(1970, 1, 1), datetime.date(1970, 1, 1), datetime.date(1970, 1, 2),
            datetime.date(1969, 12, 31)]
        seconds = dates.epoch_seconds(F.lit("2024-03-10 02:30:00").cast("timestamp_ntz"))
        assert spark.range(1).select(seconds).first()[0] == 1710037800
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_json_arrays(values):
    assert values(jsontext.array_items, ['[{"a":12.0},5,"s"]', '{"a":1}', "", "null", None, "[1"]) == [
        ['{"a":12.0}', "5", "s"], None, None, None, None, None]


def test_json_scalars(values):
    read = lambda c: jsontext.scalar(c, "a")
    assert values(read, ['{"a":12.0}', '{"a":"{x}"}', '{"a":{"b":1}}', '{"a":[1]}', '{"a":null}', '{}', "5"]) == [
        "12.0", "{x}", None, None, None, None, None]


@pytest.mark.parametrize("html, reason", [
    ("", "empty_or_too_short"), (None, "empty_or_too_short"), ("x" * 999, "empty_or_too_short"),
    ("x" * 1000 + "Access Denied page not found", "access_denied"),
    ("x" * 1000 + "Page Not Found", "404_not_found"), ("x" * 1000 + "404 NOT FOUND", "404_not_found"),
    ("x" * 1000 + "access denied", None),
])
def test_page_problem(values, html, reason):
    assert values(business.page_problem, [html]) == [reason]


def test_embedded_json(values):
    lead = "<script>var react_data = "
    assert values(pages.embedded_json, [
        lead + '{"a":{"b":"}\\"{"},"c":[1,{"d":2}]}; var y = {"q":1};</script>',
        lead + ' \n {"a":1}</script>',
        lead + '{"a":{"b":1}', lead + "{'a':1};", lead + '{"a":1,};', "<p>{}</p>", lead + "null", None,
        lead + '{"a":1,"a":12.0};', lead + '{"a":NaN};',
    ]) == ['{"a":{"b":"}\\"{"},"c":[1,{"d":2}]}', '{"a":1}', None, None, None, None, None, None, '{"a":1,"a":12.0}', None]


def test_last_of_repeated_keys_counts(spark):
    page = 'var react_data = {"name":"x","price":1,"price":12.0,"attributes":{"gender":{"value":"a"}},"attributes":{"gender":{"value":"b"}}};'
    frame = pages.with_product_data(spark.createDataFrame([(page,)], "html string"))
    record = frame.select(*pages.product_record(F.col("data"), F.lit("7"), F.lit("u"), F.lit("d"))).first()
    assert (record["price"], record["gender"], record["product_id"]) == ("12.0", "b", "7")


def test_ipv4(values):
    assert values(iprange.ipv4_number, ["10.0.0.1", "255.255.255.255", "256.1.1.1", "1.2.3", "::1", None]) == [
        167772161, 4294967295, None, None, None, None]
    assert values(iprange.address_error, ["10.0.0.1", "::1", "x"]) == [
        None, "ipv6_not_in_ipv4_ranges", "invalid_ip_address"]


def test_short_ways_of_hosts_and_numbers_agree_with_the_patterns(values):
    urls = ["https://a.b/c", "https://a.b", "https://u@a.b/c", "https://a.b:80/c", "https://a.b?x/y", "https://a.b#x/@", "https:///x", "https://",
            "https://a\u00e9.b/", "http://a.b/c", "//a.b/c", "a.b/c", " https://a.b/x ", "", None]
    hosts = ["a.b", "a.b", "a.b", "a.b", "a.b", "a.b", "https", "https", "a\u00e9.b", "a.b", "a.b", "a.b", "a.b", None, None]
    assert values(text.url_host, urls) == hosts
    pattern = lambda t: F.regexp_extract(t, numbers._PLAIN_NUMBER, 1).try_cast("double")
    texts = ["1", "-1.5", "+.5e-3", "5.e3", "0x1p3", "0X1P3", "1d", "12f", "1e5", "1e999", " 1 ", "1 2", ".", "/", "1_0", "NaN", "-", "", None, "٣", "1."]
    assert values(numbers.to_double, texts) == values(pattern, texts)
    prices = ["1,234.56", "1.234,56", "12,345", ".50", "50", "1.5", "1.23.45", "1,2,34", "a.bc", "1..2", "1.2,", "1.234.567,89", "1,234,567.8", "", None]

    def by_rule(price):
        if price is None:
            return None
        at = max(price.rfind("."), price.rfind(","))
        tail = price[at + 1:]
        if at < 0 or re.fullmatch("[0-9]{3}", tail):
            plain = price.replace(".", "").replace(",", "")
        else:
            plain = price[:at].replace("." if price[at] == "," else ",", "") + "." + tail
        return float(plain) if re.fullmatch(numbers._PLAIN_NUMBER, plain) else None

    assert values(numbers.parse_price, prices) == [by_rule(p) for p in prices]
