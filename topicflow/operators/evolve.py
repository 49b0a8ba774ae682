"""Strict schema merging, alignment to a wider schema, and unions of both."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.records import at, nullable, record_schema, with_record


class SchemaConflict(ValueError):
    """One field has two types that do not merge."""

    def __init__(self, field: str, previous: str, current: str):
        self.field, self.previous, self.current = field, previous, current
        super().__init__(f"field {field!r} changes type: previous {previous}, current {current}")


def _merge(path: str, a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        theirs = {f.name: f for f in b}
        fields = []
        for field in a:
            other = theirs.pop(field.name, None)
            if other is None:
                fields.append(T.StructField(field.name, field.dataType, True, field.metadata))
            else:
                inner = f"{path}.{field.name}" if path else field.name
                fields.append(
                    T.StructField(
                        field.name,
                        _merge(inner, field.dataType, other.dataType),
                        field.nullable or other.nullable,
                        {**(other.metadata or {}), **(field.metadata or {})},
                    )
                )
        fields += [T.StructField(f.name, f.dataType, True, f.metadata) for f in theirs.values()]
        return T.StructType(fields)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(
            _merge(path, a.elementType, b.elementType), a.containsNull or b.containsNull
        )
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(
            _merge(path, a.keyType, b.keyType),
            _merge(path, a.valueType, b.valueType),
            a.valueContainsNull or b.valueContainsNull,
        )
    if nullable(a) != nullable(b):
        raise SchemaConflict(path, a.simpleString(), b.simpleString())
    return a


def merge_schemas(current: T.StructType, record: T.StructType) -> T.StructType:
    """Union of two schemas: current fields first, new ones appended, no widening."""
    return _merge("", current, record)


def align_column(c: Column, have: T.DataType, want: T.DataType, path: str = "") -> Column:
    """``c`` on the wider type ``want``; fields it lacks become null."""
    if nullable(have) == nullable(want):
        return c
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have}
        lost = set(own) - set(want.names)
        if lost:
            raise ValueError(f"target schema lacks {sorted(lost)} under {path or 'the record'}")
        fields = [
            (
                align_column(c.getField(f.name), own[f.name], f.dataType, f"{path}.{f.name}")
                if f.name in own
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in want
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(
            c, lambda e: align_column(e, have.elementType, want.elementType, path)
        )
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        if nullable(have.keyType) != nullable(want.keyType):
            c = F.transform_keys(c, lambda k, _: align_column(k, have.keyType, want.keyType, path))
        if nullable(have.valueType) != nullable(want.valueType):
            c = F.transform_values(
                c, lambda _, v: align_column(v, have.valueType, want.valueType, path)
            )
        return c
    raise SchemaConflict(path.lstrip("."), have.simpleString(), want.simpleString())


def align_to(df: DataFrame, schema: T.StructType, column: str | None = None) -> DataFrame:
    """Rows on ``schema``: its field order, nulls where the row has no such field."""
    have = record_schema(df, column)
    if column is not None:
        return df.withColumn(column, align_column(at(column, ()), have, schema))
    own = {f.name: f.dataType for f in have}
    lost = set(own) - set(schema.names)
    if lost:
        raise ValueError(f"target schema lacks {sorted(lost)}")
    return with_record(
        df,
        None,
        [
            (
                f.name,
                align_column(at(None, [f.name]), own[f.name], f.dataType, f.name)
                if f.name in own
                else F.lit(None).cast(f.dataType),
            )
            for f in schema
        ],
    )


def union_evolving(*dfs: DataFrame) -> DataFrame:
    """Union of differently shaped frames; a type conflict raises, nothing is coerced."""
    merged = reduce(merge_schemas, [df.schema for df in dfs])
    return reduce(DataFrame.unionAll, [align_to(df, merged) for df in dfs])
