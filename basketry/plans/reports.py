"""Text reports as tables of ordered lines: (report, section, line, text).

A report is put together from the results of distributed jobs and stays a DataFrame to the
end: nothing is rendered on the driver, and `write_reports` sorts the lines by ranges and
writes them with Spark's text writer, one folder a report, parts in reading order.
Line numbers are given within a section, whose lines are one per column or field path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketry.operators import discovery, profile
from basketry.sources.readers import describe_columns

ORDER = ["report", "section", "line"]
PROFILE, DISCOVERY = "data_profile", "schema_discovery"


def fixed_lines(spark: SparkSession, report: str, section: str, texts: list[str], start: int = 0) -> DataFrame:
    """Lines that do not depend on data."""
    rows = F.posexplode(F.array(*[F.lit(t) for t in texts])).alias("n", "text")
    return spark.range(1).select(rows).select(
        F.lit(report).alias("report"), F.lit(section).alias("section"), (F.col("n") + start).cast("bigint").alias("line"), "text")


def row_lines(df: DataFrame, report: str, section: Column | str, line: Column, cells: list[Column | str]) -> DataFrame:
    """A Markdown table row per row of df; null cells are empty."""
    shown = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cells]
    text = F.concat(F.lit("| "), F.concat_ws(" | ", *shown), F.lit(" |"))
    return df.select(F.lit(report).alias("report"), (F.lit(section) if isinstance(section, str) else section).alias("section"),
                     line.cast("bigint").alias("line"), text.alias("text"))


def table_head(columns: list[str]) -> list[str]:
    return ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]


def thousands(number: Column | str) -> Column:
    return F.format_number(number, 0)


def profile_report(spark: SparkSession, tables: dict[str, tuple[DataFrame, list[str]]],
                   whole_numbers: list[tuple[str, str]], title: str = "Data profile") -> DataFrame:
    """Schema, totals and null and distinct counts of every table, then columns whose values should be whole numbers.

    Each table is read once for its counts; ``whole_numbers`` lists (table, column).
    """
    parts = [fixed_lines(spark, PROFILE, "00", [f"# {title}", ""])]
    for number, (name, (df, fields)) in enumerate(tables.items(), 1):
        counts, schema = f"{number:02d}.2", f"{number:02d}.1"
        head = [f"## Table `{name}`", "", "### Schema", "", *table_head(["Column", "Type", "Nullable"])]
        parts.append(fixed_lines(spark, PROFILE, schema, head))
        parts.append(row_lines(describe_columns(df), PROFILE, schema, F.col("ordinal_position") + len(head) - 1,
                               ["column_name", "data_type", "is_nullable"]))
        place = F.array_position(F.array(*[F.lit(f) for f in fields]), F.col("field"))
        found = profile.profile_columns(df, fields).withColumn("place", place)
        # The heading needs the total, which every row of the profile has.
        heading = F.concat(F.lit("### Null and distinct counts (total "), thousands("total"), F.lit(" rows)"))
        head = table_head(["Field", "Null count", "Null %", "Distinct count"])
        lines = F.when(F.col("place") == 1, F.array(F.struct(F.lit(1).alias("line"), heading.alias("text")))).otherwise(
            F.array().cast("array<struct<line:int,text:string>>"))
        parts.append(found.select(F.inline(lines)).select(
            F.lit(PROFILE).alias("report"), F.lit(counts).alias("section"), F.col("line").cast("bigint").alias("line"), "text"))
        parts.append(fixed_lines(spark, PROFILE, counts, [""]))
        parts.append(fixed_lines(spark, PROFILE, counts, ["", *head], start=2))
        parts.append(row_lines(found, PROFILE, counts, F.col("place") + 4, [
            "field", thousands("null_count"), F.concat(F.format_number("null_percent", 2), F.lit("%")), thousands("distinct_count")]))
    parts.append(fixed_lines(spark, PROFILE, "99", ["", "## Type checks", ""]))
    for place, (name, column) in enumerate(whole_numbers):
        broken = profile.count_uncastable(tables[name][0], column)
        verdict = F.when(F.col("invalid_count") == 0, "ok").otherwise("to be checked")
        text = F.concat(F.lit(f"- `{name}.{column}`: values that are no whole number: **"), thousands("invalid_count"), F.lit("** "), verdict)
        parts.append(broken.select(F.lit(PROFILE).alias("report"), F.lit("99").alias("section"),
                                   F.lit(3 + place).cast("bigint").alias("line"), text.alias("text")))
    return reduce(DataFrame.unionAll, parts)


def discovery_report(discovered: DataFrame, title: str = "Schema discovery") -> DataFrame:
    """Totals, the list of all field paths, and a section per group, from (grp, path, types)."""
    spark = discovered.sparkSession
    counts = discovery.field_counts(discovered)
    groups = counts.where("grp <> '*'")
    head = table_head(["Field path", "Types"])
    parts = [fixed_lines(spark, DISCOVERY, "0", [f"# {title}", ""])]
    totals = counts.agg(F.count_if(F.col("grp") != "*").alias("n"), F.max(F.when(F.col("grp") == "*", F.col("fields"))).alias("m"))
    texts = F.posexplode(F.array(
        F.concat(F.lit("- Groups: **"), thousands("n"), F.lit("**")),
        F.concat(F.lit("- Fields of all groups: **"), thousands("m"), F.lit("**")), F.lit(""))).alias("n", "text")
    parts.append(totals.select(texts).select(F.lit(DISCOVERY).alias("report"), F.lit("0").alias("section"),
                                             (F.col("n") + 2).cast("bigint").alias("line"), "text"))
    opening = ["## All fields", "", *head]
    parts.append(fixed_lines(spark, DISCOVERY, "1", opening))
    number = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("path"))
    parts.append(row_lines(discovery.master_fields(discovered), DISCOVERY, "1", number + len(opening) - 1, ["path", "types"]))
    section = F.concat(F.lit("2 "), F.col("grp"))
    heading = F.array(F.lit(""), F.concat(F.lit("### `"), F.col("grp"), F.lit("` ("), thousands("fields"), F.lit(" fields)")),
                      F.lit(""), *[F.lit(t) for t in head])
    parts.append(groups.select(section.alias("section"), F.posexplode(heading).alias("n", "text")).select(
        F.lit(DISCOVERY).alias("report"), "section", F.col("n").cast("bigint").alias("line"), "text"))
    number = F.row_number().over(Window.partitionBy("grp").orderBy("path"))
    parts.append(row_lines(discovered, DISCOVERY, section, number + 4, ["path", "types"]))
    return reduce(DataFrame.unionAll, parts)


def write_reports(lines: DataFrame, path: str) -> None:
    """One folder a report; the parts in the order of their names are the text."""
    lines.orderBy(*ORDER).select("report", "text").write.partitionBy("report").mode("overwrite").text(path)
