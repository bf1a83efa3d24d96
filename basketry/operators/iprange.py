"""IP address to geography through a table of address ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.functions.text import as_column, is_filled

PLACE = ["country_code", "country_name", "region_name", "city_name"]
NO_PLACE = "-"
BUCKET = 65536

_OCTET = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"


def ipv4_number(ip: Column | str) -> Column:
    """Dotted IPv4 address as a number; null for anything else."""
    ip = as_column(ip)
    parts = F.split(ip, r"\.")
    number = F.lit(0).cast("bigint")
    for i in range(4):
        number = number * 256 + parts[i].cast("bigint")
    return F.when(ip.rlike(_IPV4), number)


def address_error(ip: Column | str) -> Column:
    """Why an address cannot be looked up; null when it can."""
    ip = as_column(ip)
    return F.when(ip.contains(":"), "ipv6_not_in_ipv4_ranges").when(
        ~ip.rlike(_IPV4), "invalid_ip_address"
    )


def _clip_to_buckets(ranges: DataFrame) -> DataFrame:
    """One row per range and /16 block it touches, clipped to the block."""
    block = F.explode(F.sequence(F.floor(F.col("ip_from") / BUCKET),
                                 F.floor(F.col("ip_to") / BUCKET))).alias("block")
    return ranges.select("*", block).select(
        "block",
        F.greatest("ip_from", F.col("block") * BUCKET).alias("address"),
        F.lit(None).cast("string").alias("ip"),
        F.struct("ip_to", *PLACE).alias("hit"),
    )


def locate(ips: DataFrame, ranges: DataFrame, *, skip_unknown: bool = True) -> DataFrame:
    """(ip, country_code, country_name, region_name, city_name, error) per distinct address.

    Ranges must not overlap (see ``overlapping_ranges``).  Addresses and range starts
    are sorted together within a /16 block and each address takes the range that
    started last, so no address is paired with ranges it is not in.  A block holds at
    most 65 536 distinct addresses and as many range starts: no block can grow hot.

    ``skip_unknown`` drops addresses in ranges marked '-' or in no range, as a full
    load does; a repair load keeps them with '-' in every field.
    """
    distinct = ips.select("ip").where(is_filled("ip")).distinct()
    checked = distinct.withColumn("error", address_error("ip"))
    rejected = checked.where(F.col("error").isNotNull()).select(
        "ip", *[F.lit(None).cast("string").alias(c) for c in PLACE], "error"
    )

    wanted = (
        checked.where(F.col("error").isNull())
        .withColumn("address", ipv4_number("ip"))
        .select(
            F.floor(F.col("address") / BUCKET).alias("block"), "address", "ip",
            F.lit(None).cast(f"struct<ip_to: bigint, {', '.join(c + ': string' for c in PLACE)}>")
             .alias("hit"),
        )
    )
    # At equal addresses the range start (null ip) sorts first.
    walk = Window.partitionBy("block").orderBy("address", F.asc_nulls_first("ip"))
    nearest = F.last("hit", ignorenulls=True).over(
        walk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        _clip_to_buckets(ranges).unionByName(wanted)
        .withColumn("near", nearest)
        .where(F.col("ip").isNotNull())
    )
    inside = F.col("near.ip_to") >= F.col("address")
    located = found.select(
        "ip",
        *[F.when(inside, F.col(f"near.{c}")).otherwise(NO_PLACE).alias(c) for c in PLACE],
        F.lit(None).cast("string").alias("error"),
    )
    if skip_unknown:
        located = located.where(F.col("country_code") != NO_PLACE)
    return located.unionByName(rejected)


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that start before an earlier one has ended, as (ip_from, ip_to)."""
    starts = ranges.select(
        "ip_from", "ip_to",
        F.explode(F.sequence(F.floor(F.col("ip_from") / BUCKET),
                             F.floor(F.col("ip_to") / BUCKET))).alias("block"),
    )
    before = (
        Window.partitionBy("block").orderBy("ip_from", "ip_to")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        starts.withColumn("ended", F.max("ip_to").over(before))
        .where(F.col("ip_from") <= F.col("ended"))
        .select("ip_from", "ip_to").distinct()
    )
