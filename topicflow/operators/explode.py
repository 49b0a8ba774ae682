"""One row per element of a list container."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.records import at, quote, record_schema


def container_field(schema: T.StructType) -> T.StructField | None:
    """The only field, if it is a list of records; else None."""
    if len(schema) == 1:
        field = schema[0]
        if isinstance(field.dataType, T.ArrayType) and isinstance(
            field.dataType.elementType, T.StructType
        ):
            return field
    return None


def explode_schema(schema: T.StructType) -> T.StructType:
    field = container_field(schema)
    return schema if field is None else field.dataType.elementType


def explode_container(
    df: DataFrame, column: str | None = None, keep: Iterable[str] = (), outer: bool = False
) -> DataFrame:
    """Rows whose record is nothing but a list of records become one row per element.

    Any other shape comes back unchanged.  A null or empty list gives no rows,
    or one row of nulls with ``outer``.
    """
    keep = tuple(keep)
    schema = record_schema(df, column)
    if column is None:
        schema = T.StructType([f for f in schema if f.name not in keep])
    field = container_field(schema)
    if field is None:
        return df
    items = at(column, [field.name])
    if column is None:
        generator = F.inline_outer(items) if outer else F.inline(items)
        return df.select(*[at(None, [k]) for k in keep], generator)
    others = [F.col(quote(c)) for c in df.columns if c != column]
    generator = F.explode_outer(items) if outer else F.explode(items)
    return df.select(*others, generator.alias(column))
