"""Surrogate keys and masking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.functions.text import as_column, strip_space

UNKNOWN_KEY = -1


def surrogate_key(text: Column | str) -> Column:
    """60-bit key from the MD5 of a text: never negative, null for null."""
    digest = F.substring(F.md5(as_column(text)), 1, 15)
    return F.conv(digest, 16, 10).cast("bigint")


def joined_key(*parts: Column) -> Column:
    """Key over parts joined with '-'; null as soon as one part is null."""
    texts: list[Column] = []
    for part in parts:
        texts += [F.lit("-"), part.cast("string")]
    return surrogate_key(F.concat(*texts[1:]))


def or_unknown(key: Column | str) -> Column:
    return F.coalesce(as_column(key), F.lit(UNKNOWN_KEY).cast("bigint"))


def mask_email(email: Column | str) -> Column:
    """SHA-256 hex of the trimmed, lower-cased address."""
    return F.sha2(F.lower(strip_space(email)), 256)
