"""Type rewrites: walk a type once at plan time, then one positional cast."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import types as T

from topicflow.records import reject_collisions


def rewrite(
    dtype: T.DataType,
    leaf: Callable[[T.DataType], T.DataType] = lambda t: t,
    name: Callable[[str], str] = lambda n: n,
) -> T.DataType:
    if isinstance(dtype, T.StructType):
        reject_collisions((f.name, name(f.name)) for f in dtype)
        return T.StructType(
            [
                T.StructField(name(f.name), rewrite(f.dataType, leaf, name), f.nullable, f.metadata)
                for f in dtype
            ]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(rewrite(dtype.elementType, leaf, name), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(
            rewrite(dtype.keyType, leaf, name),
            rewrite(dtype.valueType, leaf, name),
            dtype.valueContainsNull,
        )
    return leaf(dtype)


def decimal_to_double(dtype: T.DataType) -> T.DataType:
    return T.DoubleType() if isinstance(dtype, T.DecimalType) else dtype
