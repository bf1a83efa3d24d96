"""Product data embedded in page source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.business import page_problem
from basketry.functions.jsontext import once
from basketry.functions.text import as_column
from basketry.sources.schemas import PRODUCT_COLUMNS

MARKER = "var react_data = "
NO_DATA, NO_NAME, OK = "react_data_not_found", "no_product_name_found", "ok"

# Columns that do not come straight from a field of the same name.
_DERIVED = {"product_id", "source_url", "domain_used", "gender", "massiv"}
_PLAIN = [c for c in PRODUCT_COLUMNS if c not in _DERIVED]
_STRICT = {"columnNameOfCorruptRecord": "_broken", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_EMBEDDED = (
    "product_id string, "
    + ", ".join(f"{c} string" for c in _PLAIN)
    + ", gender string, attributes string, _broken string"
)


def embedded_tail(html: Column | str, marker: str = MARKER) -> Column:
    """Page source from the first '{' after the marker on; null without one."""
    html = as_column(html)
    start = F.locate(marker, html)
    behind = F.when(start > 0, F.substr(html, start + len(marker)))
    brace = F.locate("{", behind)
    return F.when(brace > 0, F.substr(behind, brace))


def embedded_json(html: Column | str, marker: str = MARKER) -> Column:
    """The object assigned to the marker as JSON text; null if absent, cut off or malformed.

    A JSON parser stops at the brace that closes the object it started with, braces in
    strings and escaped quotes included, so the rest of the page needs no trimming.  Numbers
    keep a fraction of zero, and a key that occurs twice stays so; ``jsontext.fields`` reads the
    last one.
    """
    tail = embedded_tail(html, marker)
    strict = F.from_json(tail, "_broken string", _STRICT)["_broken"].isNull()
    return F.when(strict, F.get_json_object(tail, "$"))


def with_product_data(stored: DataFrame, name: str = "data") -> DataFrame:
    """Adds the fields of the object embedded in ``html`` as a struct; null if there is none.

    Cut and parsed once a page, however many of the fields are used.
    """
    tailed = stored.select("*", once(embedded_tail("html")).alias("__tail"))
    parsed = tailed.select("*", once(F.from_json("__tail", _EMBEDDED, _STRICT)).alias("__parsed"))
    usable = F.col("__parsed._broken").isNull() & ~F.col("__tail").rlike(r"^\{\s*\}")
    return parsed.withColumn(name, F.when(usable, F.col("__parsed"))).drop("__tail", "__parsed")


def product_record(data: Column, product_id: Column | str, url: Column, domain: Column | str) -> list[Column]:
    """The 21 product columns from ``with_product_data``; a missing id falls back to the input.

    Of a key that occurs twice the last counts, but inside the attributes the first: they stay
    text, as a second parse would cost more than a lookup.
    """
    def attribute(name: str) -> Column:
        # Shops write an empty map as [], false or an empty text; none of them has values.
        return F.get_json_object(data["attributes"], f"$.{name}.value")

    derived = {
        "product_id": F.coalesce(data["product_id"], as_column(product_id)),
        "source_url": url,
        "domain_used": as_column(domain),
        # An empty gender counts as missing.
        "gender": F.coalesce(F.when(~data["gender"].isin("", "false", "[]", "{}"), data["gender"]), attribute("gender")),
        "massiv": attribute("massiv"),
    }
    return [
        (derived[c] if c in derived else data[c]).alias(c) for c in PRODUCT_COLUMNS
    ]


def page_outcome(html: Column | str, data: Column) -> Column:
    """'ok', or the first thing that is wrong with the page."""
    unnamed = F.coalesce(data["name"], F.lit("")) == ""
    return F.coalesce(
        page_problem(html),
        F.when(data.isNull(), NO_DATA).when(unnamed, NO_NAME),
        F.lit(OK),
    )
