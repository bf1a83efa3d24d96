"""Safe casts and prices."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.functions.text import as_column

NUMERIC = "decimal(38,9)"

_PLAIN_NUMBER = r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)\s*$"


def to_long(text: Column | str) -> Column:
    """Whole number or null."""
    return as_column(text).try_cast("bigint")


def to_double(text: Column | str) -> Column:
    """Finite decimal number or null; keeps Java suffixes such as ``12d`` out.

    Of texts that begin and end like a plain number the cast takes no others but hexadecimal
    ones, so most texts need not be matched with the pattern.
    """
    column = as_column(text)
    plain = (F.substring(column, 1, 1).between("+", "9") & F.substring(column, -1, 1).between(".", "9")
             & ~column.contains("x") & ~column.contains("X"))
    return F.when(plain, column).otherwise(F.regexp_extract(column, _PLAIN_NUMBER, 1)).try_cast("double")


def to_numeric(value: Column | str) -> Column:
    return as_column(value).try_cast(NUMERIC)


def float_text_to_long(text: Column | str) -> Column:
    """'3251020421.0' -> 3251020421, rounding half away from zero."""
    return F.round(to_double(text)).try_cast("bigint")


def parse_price(text: Column | str) -> Column:
    """Number from a price written in European or US style.

    The last separator is the decimal mark, unless exactly three digits follow it:
    then every separator groups thousands.  Anything left over that is not a number
    gives null.  A mark in front of the last two characters, as most prices have it, is
    found without looking for the last one.
    """
    price = as_column(text)
    cents, cents_mark = F.substring(price, -2, 2), F.substring(price, -3, 1)
    in_cents = cents_mark.isin(".", ",") & ~cents.contains(".") & ~cents.contains(",")
    units = F.replace(F.substring(price, F.lit(1), F.length(price) - 3), F.when(cents_mark == ",", ".").otherwise(","), F.lit(""))
    digits = F.translate(price, ".,", "")
    tail = F.substring_index(F.translate(price, ",", "."), ".", -1)
    head_length = F.length(price) - F.length(tail) - 1
    mark = F.substring(price, head_length + 1, F.lit(1))
    group_mark = F.when(mark == ",", ".").otherwise(",")
    head = F.replace(F.substring(price, F.lit(1), head_length), group_mark, F.lit(""))
    only_groups = (F.length(tail) == 3) & tail.rlike("^[0-9]{3}$")
    plain = F.when((head_length < 0) | only_groups, digits).otherwise(F.concat(head, F.lit("."), tail))
    return to_double(F.when(in_cents, F.concat(units, F.lit("."), cents)).otherwise(plain))


def usd_price(price: Column | str, rate: Column | str) -> Column:
    """Price in US dollars to the cent; no price counts 0, no rate counts 1.

    The product is taken on decimals: rounding a binary product to cents goes wrong
    on ties.  A price or rate too large for them gives null.
    """
    amount = F.coalesce(as_column(price), F.lit(0.0)).try_cast("decimal(29,9)")
    factor = F.coalesce(as_column(rate), F.lit(1.0)).try_cast("decimal(18,12)")
    return F.round(amount * factor, 2).cast(NUMERIC)


def share_percent(part: Column | str, total: Column | str) -> Column:
    """Percentage, 0 for an empty total."""
    part, total = as_column(part), as_column(total)
    return F.when(total > 0, part / total * 100).otherwise(F.lit(0.0))
