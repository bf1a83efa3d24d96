"""Schema discovery over JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketry.functions.jsontext import observed_type, once
from basketry.operators.pick import first_n_per_key

SAMPLE_SIZE = 10

_NODE = "struct<path: string, type: string, value: variant, in_array: boolean>"


def _node(path: Column, value: Column, in_array: bool) -> Column:
    return F.struct(path.alias("path"), observed_type(value).alias("type"), value.alias("value"), F.lit(in_array).alias("in_array"))


def _children(node: Column) -> Column:
    """The fields of an object, or the first element of an array that is not itself inside one."""
    path, value = node["path"], node["value"]
    fields = F.transform(
        F.map_entries(F.try_variant_get(value, "$", "map<string, variant>")),
        lambda e: _node(F.when(path == "", e["key"]).otherwise(F.concat_ws(".", path, e["key"])), e["value"], False))
    first = F.try_variant_get(value, "$[0]", "variant")
    return (F.when(node["type"] == "object", fields)
            .when((node["type"] == "array") & ~node["in_array"] & first.isNotNull(),
                  F.array(_node(F.concat(path, F.lit("[]")), first, True)))
            .otherwise(F.array().cast(f"array<{_NODE}>")))


def nesting_depth(df: DataFrame, document: str) -> int:
    """Deepest nesting of brackets in any document; texts in quotes do not count."""
    plain = F.regexp_replace(F.regexp_replace(F.col(document), r"\\.", ""), r'"[^"]*+"', "")
    brackets = F.regexp_replace(plain, r"[^\[\]{}]++", "")
    steps = F.transform(F.split(brackets, ""), lambda b: F.when(b.isin("[", "{"), 1).when(b.isin("]", "}"), -1).otherwise(0))
    at = F.aggregate(steps, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), lambda a, step: F.struct(
        (a["now"] + step).alias("now"), F.greatest(a["most"], a["now"] + step).alias("most")))
    return df.agg(F.max(at["most"]).alias("depth")).first()["depth"] or 0


def broken_documents(df: DataFrame, document: str) -> DataFrame:
    """Rows whose document is no JSON, for the quarantine; null documents are not among them."""
    return df.where(F.col(document).isNotNull() & F.try_parse_json(document).isNull())


def document_paths(df: DataFrame, group: str, document: str) -> DataFrame:
    """(grp, path, type) of every field of the JSON documents, each as often as it occurs.

    Breadth first, one level of nesting after the other, for as many levels as the documents
    have.  Arrays are judged by their first element; an array right inside an array is labelled
    but not entered.  Documents that are no JSON, those with a key twice in one object
    included, have no paths; ``broken_documents`` lists them.  Whole numbers beyond 64 bits
    count as float.
    """
    docs = df.select(F.col(group).alias("grp"), F.try_parse_json(F.col(document)).alias("value")).where("value is not null")
    depth = nesting_depth(df.where(F.try_parse_json(document).isNotNull()), document)
    level = docs.select("grp", once(_node(F.lit(""), F.col("value"), False)).alias("node"))
    for _ in range(depth):
        # A node whose children were made has no value left, so that it is not entered again.
        done = F.struct(F.col("node.path").alias("path"), F.col("node.type").alias("type"),
                        F.lit(None).cast("variant").alias("value"), F.lit(True).alias("in_array"))
        level = level.select("grp", F.explode(F.concat(
            F.array(done), F.when(F.col("node.value").isNotNull(), _children(F.col("node"))).otherwise(
                F.array().cast(f"array<{_NODE}>")))).alias("node"))
    return level.where("node.path <> ''").select("grp", "node.path", "node.type")


def discover_schema(df: DataFrame, group: str, document: str, order: list[Column], *,
                    sample_size: int | None = SAMPLE_SIZE) -> DataFrame:
    """(grp, path, types) for the first documents of each group; None looks at all of them."""
    docs = df if sample_size is None else first_n_per_key(df, [group], order, sample_size)
    return document_paths(docs, group, document).groupBy("grp", "path").agg(
        F.array_join(F.sort_array(F.collect_set("type")), ", ").alias("types")
    )


def master_fields(discovered: DataFrame) -> DataFrame:
    """(path, types) over all groups."""
    return (
        discovered.select("path", F.explode(F.split("types", ", ")).alias("type"))
        .groupBy("path")
        .agg(F.array_join(F.sort_array(F.collect_set("type")), ", ").alias("types"))
    )


def field_counts(discovered: DataFrame) -> DataFrame:
    """(grp, fields): distinct paths per group, and overall under the name '*'."""
    per_group = discovered.groupBy("grp").agg(F.count_distinct("path").alias("fields"))
    overall = discovered.agg(F.count_distinct("path").alias("fields"))
    return per_group.unionByName(overall.withColumn("grp", F.lit("*")))
