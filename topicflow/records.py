"""Names and small helpers every operator shares.

A topic row is an envelope (``topic, partition, offset, timestamp``) plus the
record itself.  Operators take ``column=None`` when the record is the whole
row, or the name of a struct column (normally ``"value"``) when it travels
beside the envelope, so a payload field called ``offset`` never collides.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.session import materialise

# The envelope has the columns of Spark's own Kafka source.
ENVELOPE = ("topic", "partition", "offset", "timestamp")
TOPIC_PARTITION = ("topic", "partition")
INVALID = "_invalid"


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def record_schema(df: DataFrame, column: str | None) -> T.StructType:
    if column is None:
        return df.schema
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.StructType):
        raise TypeError(f"{column} must be a struct, found {dtype.simpleString()}")
    return dtype


def at(column: str | None, path: Iterable[str]) -> Column:
    parts = list(path) if column is None else [column, *path]
    return F.col(".".join(quote(p) for p in parts))


def with_record(
    df: DataFrame, column: str | None, fields: list[tuple[str, Column]], keep: Iterable[str] = ()
) -> DataFrame:
    """Replace the record by ``fields``; a pure projection either way."""
    columns = [c.alias(n) for n, c in fields]
    if column is None:
        return df.select(*[F.col(quote(k)) for k in keep], *columns)
    return df.withColumn(column, F.struct(*columns) if columns else F.struct())


def reject_collisions(sources: Iterable[tuple[str, str]]) -> None:
    """Raise when two source paths end up under one name.

    Compared without case, because Spark resolves names that way.
    """
    seen: dict[str, str] = {}
    for source, name in sources:
        other = seen.setdefault(name.lower(), source)
        if other != source:
            raise ValueError(f"{other!r} and {source!r} both become column {name!r}")


def nullable(dtype: T.DataType) -> T.DataType:
    """The same type with every field nullable and without field metadata."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable(dtype.elementType))
    if isinstance(dtype, T.MapType):
        return T.MapType(nullable(dtype.keyType), nullable(dtype.valueType))
    return dtype


def add_reason(df: DataFrame, reason: Column) -> DataFrame:
    """Flag rows where ``reason`` is not null; the first reason found stays."""
    fresh = F.when(reason.isNotNull(), F.array(reason)).otherwise(
        F.array().cast("array<string>")
    )
    if INVALID not in df.columns:
        return df.withColumn(INVALID, fresh)
    return df.withColumn(
        INVALID, F.when(F.size(INVALID) > 0, F.col(INVALID)).otherwise(fresh)
    )


def measured(df: DataFrame) -> DataFrame:
    """A written copy, so that the planner knows its size in bytes.

    It broadcasts the copy only below its own limit; a larger one is joined
    through a shuffle, which adaptive execution may split when one key is hot.
    """
    return materialise(df)
