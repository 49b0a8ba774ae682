"""Conversions that run before anything else, on rows with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from topicflow.functions.types import decimal_to_double, rewrite
from topicflow.records import at, record_schema, with_record


def _cast_record(df: DataFrame, column: str | None, target: T.StructType) -> DataFrame:
    source = record_schema(df, column)
    if column is not None:
        return df.withColumn(column, at(column, ()).cast(target))
    return with_record(
        df, None, [(new.name, at(None, [old.name]).cast(new.dataType)) for old, new in zip(source, target)]
    )


def decimals_to_double(df: DataFrame, column: str | None = None) -> DataFrame:
    """Every decimal, at any depth, becomes a double."""
    return _cast_record(df, column, rewrite(record_schema(df, column), leaf=decimal_to_double))


def lowercase_fields(df: DataFrame, column: str | None = None) -> DataFrame:
    """Every field name, at any depth, in lower case; map keys are data and stay."""
    return _cast_record(df, column, rewrite(record_schema(df, column), name=str.lower))
