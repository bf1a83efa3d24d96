"""Geography of the addresses seen in events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketry.operators.iprange import locate
from basketry.operators.lookup import missing_keys, rows_with_keys
from basketry.session import cut_lineage
from basketry.sinks.writers import (
    append_rows, export_jsonl, replace_rows, split_rows, write_csv, write_quarantine,
)
from basketry.sources.schemas import IP_LOCATION_COLUMNS


def _split(located: DataFrame) -> tuple[DataFrame, DataFrame]:
    # Written once, so that neither output looks the addresses up again.
    good, bad = split_rows(cut_lineage(located, "located"), F.col("error").isNotNull())
    return good.select(*IP_LOCATION_COLUMNS), bad.select("ip", "error")


def full_load(events: DataFrame, ranges: DataFrame, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(locations, errors) for every address; unknown ranges are skipped."""
    addresses = events.select("ip").distinct()
    if limit is not None:
        addresses = addresses.limit(limit)
    return _split(locate(addresses, ranges, skip_unknown=True))


def repair_load(events: DataFrame, existing: DataFrame, ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(locations, errors) for addresses without a location yet; unknown ranges are kept."""
    return _split(locate(missing_keys(events, existing, "ip"), ranges, skip_unknown=False))


def write_full_load(events: DataFrame, ranges: DataFrame, *, store: str, csv: str, errors: str,
                    limit: int | None = None) -> None:
    """Replace the stored locations, write them as CSV, and the rejected addresses beside."""
    good, bad = full_load(events, ranges, limit)
    replace_rows(good, store)
    write_csv(good, csv, IP_LOCATION_COLUMNS)
    write_quarantine(bad, errors, ["ip", "error"])


def write_repair_load(events: DataFrame, existing: DataFrame, ranges: DataFrame, *, store: str,
                      delta: str, errors: str) -> None:
    """Append the missing locations to the store, and write them and the rejected addresses."""
    good, bad = repair_load(events, existing, ranges)
    append_rows(good, store)
    export_jsonl(good, delta)
    write_quarantine(bad, errors, ["ip", "error"])


def delta_export(events: DataFrame, loaded: DataFrame, store: DataFrame) -> DataFrame:
    """Stored locations of the addresses that the warehouse does not have."""
    absent = missing_keys(events, loaded, "ip")
    return rows_with_keys(store, absent, "ip").select(*IP_LOCATION_COLUMNS)
