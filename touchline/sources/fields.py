"""Field maps of feeds: JSON lines, CSV with a header and XML rows become typed columns; a value that doesn't fit is an error.

A map is a list of ``Field``. Absent values are null; a ``required`` field that is null is an error, as is text that its type
can't hold. Errors come when rows are read, not when the plan is built."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """``column`` of ``type`` from ``path``: ``$.a.b[0]`` in JSON, a header in CSV; in XML ``@x``, ``child/@x``, ``child[]/@x``
    (a list of all children's values) or ``child?`` (whether there is one). JSON's type ``json`` keeps a nested value as text."""

    column: str
    path: str
    type: str = "string"
    required: bool = False


def _named(field: Field, value: Column) -> Column:
    if field.required:
        value = F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(f"{field.column}: no value at {field.path}")))
    return value.alias(field.column)


def _typed(field: Field, text: Column) -> Column:
    if field.type == "string":
        return text
    value = text.try_cast(field.type)
    wrong = F.raise_error(F.concat(F.lit(f"{field.column}: not a {field.type}: "), text))
    return F.when(text.isNull() | value.isNotNull(), value).otherwise(wrong)


def json_fields(lines: DataFrame, fields: list[Field], text: str = "value") -> DataFrame:
    """A row a line; each line is parsed once. Lines that are no JSON are errors, null lines give nulls."""
    parsed = lines.select(F.parse_json(text).alias("__json"))

    def value(field: Field) -> Column:
        if field.type == "json":
            return F.to_json(F.variant_get("__json", field.path, "variant"))
        return F.variant_get("__json", field.path, field.type)

    return parsed.select(*(_named(f, value(f)) for f in fields))


def csv_fields(spark: SparkSession, path: str, fields: list[Field]) -> DataFrame:
    """Rows of CSV files with a header. Columns that the header lacks are null if they aren't required; others are pruned."""
    rows = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"').csv(path)
    text = lambda f: F.col(f"`{f.path}`") if f.path in rows.columns else F.lit(None).cast("string")
    return rows.select(*(_named(f, _typed(f, text(f))) for f in fields))


def xml_fields(spark: SparkSession, path: str, row_tag: str, fields: list[Field]) -> DataFrame:
    """A row an element ``row_tag``; the schema follows from the paths, so the files are read once."""
    attributes: dict[str, None] = {}
    children: dict[str, dict[str, None]] = {}
    for f in fields:
        child, _, attribute = f.path.rpartition("/@") if "/@" in f.path else ("", "", f.path[1:]) if f.path[0] == "@" else (f.path, "", "")
        if child:
            children.setdefault(child.rstrip("?").removesuffix("[]"), {}).update({attribute: None} if attribute else {})
        else:
            attributes[attribute] = None
    text = lambda names: [T.StructField(f"_{n}", T.StringType()) for n in names]
    nested = [T.StructField(c, T.ArrayType(T.StructType([*text(a), T.StructField("_VALUE", T.StringType())]))) for c, a in children.items()]
    rows = spark.read.format("xml").option("rowTag", row_tag).option("mode", "FAILFAST").schema(T.StructType([*text(attributes), *nested])).load(path)

    def value(f: Field) -> Column:
        if f.path[0] == "@":
            return _typed(f, F.col(f"`_{f.path[1:]}`"))
        if f.path.endswith("?"):
            return F.col(f"`{f.path[:-1]}`").isNotNull()
        child, attribute = f.path.split("/@")
        each = F.transform(F.col(f"`{child.removesuffix('[]')}`"), lambda x: _typed(f, x[f"_{attribute}"]))
        return F.coalesce(each, F.array().cast(f"array<{f.type}>")) if child.endswith("[]") else F.get(each, F.lit(0))

    return rows.select(*(_named(f, value(f)) for f in fields))
