"""JSON held as text.

Numbers keep the way they were written ('12.0' stays '12.0'), which decides whether
a later cast to a whole number succeeds.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from basketry.functions.text import as_column


def array_items(json: Column | str) -> Column:
    """Elements of a JSON array as JSON texts; null for anything that is not an array."""
    return F.from_json(as_column(json), "array<string>")


def _scalar_only(value: Column, json: Column, name: str) -> Column:
    # Objects and arrays come back as their JSON text.  Only a value that looks like
    # one pays for the second, typed parse; the nested branch keeps codegen from
    # evaluating it up front for every row.
    kind = F.schema_of_variant(
        F.try_variant_get(F.try_parse_json(json), f"$.{name}", "variant")
    )
    # A text that begins with a bracket stands behind a quote, as it is or escaped.
    quoted = json.contains('"{') | json.contains('"[') | json.contains('"\\u')
    is_text = F.when(quoted, F.when(kind == "STRING", value))
    return F.when(value.startswith("{") | value.startswith("["), is_text).otherwise(value)


def scalar(json: Column | str, name: str) -> Column:
    """Text of one top-level scalar; null for objects, arrays and JSON null."""
    column = as_column(json)
    return _scalar_only(F.get_json_object(column, f"$.{name}"), column, name)


def once(expression: Column) -> Column:
    """The value of a costly expression as a column of its own.

    As a generator it is evaluated once a row; as a plain projection the optimizer
    would copy it into every place that uses one of its fields.
    """
    return F.explode(F.array(expression))


def fields(json: Column | str, names: list[str]) -> Column:
    """Several top-level fields of an object as a struct of texts, nested ones included."""
    return F.from_json(as_column(json), ", ".join(f"`{n}` string" for n in names))


def scalar_field(parsed: str, json: str, name: str) -> Column:
    """One field of ``fields``, provided it is a scalar in the document."""
    return _scalar_only(F.col(parsed)[name], F.col(json), name)


def items_fields(json: Column | str, names: list[str]) -> Column:
    """Scalar top-level fields of the elements of a JSON array, as structs of texts, from one parse.

    Null for anything that is not an array; an element that is no object has null fields.
    """
    column = as_column(json)
    struct = ", ".join(f"`{n}`: string" for n in names)
    # Spark reads an object as an array of one, and nothing of an array in which an element is
    # no object: both take the way over the elements' texts.
    parsed = F.when(column.startswith("["), F.from_json(column, f"array<struct<{struct}>>"))
    items = F.coalesce(parsed, F.transform(array_items(column), lambda item: fields(item, names)))

    def scalars(item: Column, index: Column) -> Column:
        return F.struct(*[_scalar_only(item[n], F.get(array_items(column), index), n).alias(n) for n in names])

    return F.transform(items, scalars)


def observed_type(variant: Column | str) -> Column:
    """Label of a variant's type: null, bool, int, float, string, array or object."""
    kind = F.schema_of_variant(as_column(variant))
    return (
        F.when(kind == "VOID", "null")
        .when(kind == "BOOLEAN", "bool")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string")
        .when(kind == "BIGINT", "int")
        .otherwise("float")
    )
