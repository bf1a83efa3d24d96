"""Calendar helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.functions.text import as_column

_SECONDS_PER_DAY = 86400


def utc_date(epoch_seconds: Column | str) -> Column:
    """UTC calendar day of an epoch second."""
    return F.date_from_unix_date(
        F.floor(as_column(epoch_seconds) / _SECONDS_PER_DAY).cast("int")
    )


def epoch_seconds(zoneless: Column | str) -> Column:
    """Epoch second of a zone-less timestamp read as UTC.

    Put together from its parts: a timestamp difference would go through the session
    time zone and come out wrong in a daylight-saving gap.
    """
    moment = as_column(zoneless)
    days = F.unix_date(moment.cast("date")).cast("bigint")
    clock = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    return days * _SECONDS_PER_DAY + clock


def date_key(day: Column | str) -> Column:
    """yyyymmdd as a number."""
    day = as_column(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def sunday_week(day: Column | str) -> Column:
    """Week of the year, 0 to 53; weeks start on Sunday and days before the first are week 0."""
    day = as_column(day)
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7)


def is_weekend(day: Column | str) -> Column:
    return F.dayofweek(as_column(day)).isin(1, 7)


def iso_text(moment: Column | str) -> Column:
    """ISO-8601 text of a zone-less timestamp, with six digits of fraction if there is one."""
    text = F.replace(as_column(moment).cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))
    return F.when(text.contains("."), F.rpad(text, 26, "0")).otherwise(text)
