"""Shop-specific rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.functions.keys import UNKNOWN_KEY, joined_key, surrogate_key
from basketry.functions.text import (
    as_column, blank_to_null, capitalize_words, contains_any, strip_space,
)

UNKNOWN_CODE = "UNK"

# Gender words as they occur in product data, lower case.
FEMALE_WORDS = [
    "women", "female", "femelle", "femeie", "kadın", "mujer", "női",
    "frauen", "sieviete", "vrouw", "женски", "donna", "kvinne",
    "naine", "nainen", "žena", "ženski",
]
MALE_WORDS = ["men"]
KIDS_WORDS = ["kids", "çocuk"]

# Parts of place names that mark a failed lookup.
BROKEN_PLACE_WORDS = ["INVALID", "MISSING"]

# Page outcome labels and the texts that lead to them.
MIN_PAGE_LENGTH = 1000
TOO_SHORT = "empty_or_too_short"
DENIED_TEXT, DENIED = "Access Denied", "access_denied"
NOT_FOUND_TEXTS, NOT_FOUND = ["404 NOT FOUND", "PAGE NOT FOUND"], "404_not_found"


def gender_group(word: Column | str) -> Column:
    word = F.lower(strip_space(word))
    return (
        F.when(word.isin(FEMALE_WORDS), "Female")
        .when(word.isin(MALE_WORDS), "Male")
        .when(word.isin(KIDS_WORDS), "Kids")
        .otherwise("Unknown")
    )


def country_code(text: Column | str) -> Column:
    """Two-letter upper-case code, else 'UNK'."""
    code = F.upper(blank_to_null(text))
    return F.when(code.rlike(r"^[A-Z]{2}\z"), code).otherwise(UNKNOWN_CODE)


def place_name(text: Column | str) -> Column:
    """Capitalised name; blank, '-' and failed lookups become 'UNK'."""
    name = capitalize_words(blank_to_null(text))
    usable = name.isNotNull() & (name != "-") & ~contains_any(name, BROKEN_PLACE_WORDS)
    return F.when(usable, name).otherwise(UNKNOWN_CODE)


def _unless_unknown(unknown: Column, key: Column) -> Column:
    return F.when(unknown, F.lit(UNKNOWN_KEY).cast("bigint")).otherwise(key)


def location_key(code: Column | str, region: Column | str, city: Column | str) -> Column:
    code, region, city = map(as_column, (code, region, city))
    unknown = (
        (code == UNKNOWN_CODE) & (region == UNKNOWN_CODE) & (city == UNKNOWN_CODE)
    )
    return _unless_unknown(unknown, joined_key(code, region, city))


def currency_key(code: Column | str) -> Column:
    code = as_column(code)
    return _unless_unknown(code == UNKNOWN_CODE, surrogate_key(code))


def page_problem(html: Column | str) -> Column:
    """Why a page is unusable, null when it is fine; the first rule that fires wins."""
    html = as_column(html)
    return (
        F.when(html.isNull() | (F.length(html) < MIN_PAGE_LENGTH), TOO_SHORT)
        .when(html.contains(DENIED_TEXT), DENIED)
        .when(contains_any(html, NOT_FOUND_TEXTS), NOT_FOUND)
    )
