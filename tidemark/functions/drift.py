"""Fields of JSON documents that no declared schema names yet.

A declared schema drops what it does not know. Here documents are parsed to VARIANT,
the schema of all of them is merged in one aggregate, and fields beyond the declared
ones come out as typed columns next to the declared ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def variant(text: Column) -> Column:
    """The document; NULL where the text is no JSON, also under ANSI."""
    return F.try_parse_json(text)


def merged_schema(df: DataFrame, column: str) -> T.StructType:
    """The schema that all documents of a text column share; empty if none is an object.

    One row comes to the driver, whose size follows the number of different fields.
    """
    found = df.agg(F.schema_of_variant_agg(variant(F.col(column).cast("string"))).alias("s"))
    text = found.first().s
    if text is None or not text.startswith("OBJECT<"):
        return T.StructType([])
    parsed = T.DataType.fromDDL(text.replace("OBJECT<", "STRUCT<"))
    return parsed if isinstance(parsed, T.StructType) else T.StructType([])


def undeclared(found: T.StructType, declared: Sequence[str]) -> list[T.StructField]:
    """Fields that were found but not declared, in order of their names.

    Where documents disagree on a type, or a field is always null, it is read as text.
    """
    out = []
    for field in sorted(found.fields, key=lambda f: f.name):
        if field.name not in declared:
            plain = isinstance(field.dataType, (T.VariantType, T.NullType))
            out.append(T.StructField(field.name, T.StringType() if plain else field.dataType))
    return out


def members(document: Column) -> Column:
    """The fields of an object by name; NULL for another document. Any name will do."""
    return F.try_variant_get(document, "$", "map<string,variant>")


def field_of(fields: Column, field: T.StructField) -> Column:
    """A field in its type; NULL where a document lacks it or has another type."""
    value = F.try_element_at(fields, F.lit(field.name))
    return F.try_variant_get(value, "$", field.dataType.simpleString())


def with_undeclared(
    df: DataFrame, column: str, declared: Sequence[str], prefix: str = "extra_"
) -> DataFrame:
    """``df`` with a column for each field of its documents that is not declared.

    Two passes: one merges the schema, one extracts. Documents are parsed once in each.
    """
    fields = undeclared(merged_schema(df, column), declared)
    document = members(variant(F.col(column).cast("string")))
    parsed = df.withColumn("_fields", document)
    return parsed.select(
        *[F.col(f"`{name}`") for name in df.columns],
        *[field_of(F.col("_fields"), field).alias(prefix + field.name) for field in fields],
    )
