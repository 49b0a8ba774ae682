"""Keyed tables: the row with the highest order value per key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.evolve import union_evolving
from topicflow.records import quote


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the highest ``order``, then the highest ``tiebreak`` columns.

    An aggregate, not a window: each map task keeps one row per key before the
    shuffle, so a key with very many rows costs no more than any other.
    """
    missing = [c for c in (*keys, order, *tiebreak) if c not in df.columns]
    if missing:
        raise ValueError(f"not in the frame: {', '.join(missing)}")
    rank = F.struct(*[F.col(quote(c)) for c in (order, *tiebreak)])
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(quote(c)) for c in rest])
    best = df.groupBy(*[quote(k) for k in keys]).agg(F.max_by(row, rank).alias("__row"))
    return best.select(
        *[
            F.col(quote(c)) if c in keys else F.col(f"__row.{quote(c)}").alias(c)
            for c in df.columns
        ]
    )


def merge_latest(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order: str,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Upsert: both frames on one schema, then the latest row per key."""
    return latest_per_key(union_evolving(existing, new), keys, order, tiebreak)


def overlong_strings(df: DataFrame, length: int) -> DataFrame:
    """(column, rows, longest) for text columns with values over ``length`` characters."""
    if not 1 <= length <= 65000:
        raise ValueError("length must be between 1 and 65000")
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    per_column = []
    for name in names:
        n = F.length(quote(name))
        per_column.append(
            F.struct(
                F.lit(name).alias("column"),
                F.sum(F.when(n > length, 1).otherwise(0)).alias("rows"),
                F.max(n).alias("longest"),
            )
        )
    report = df.agg(F.array(*per_column).alias("r")).select(F.inline("r"))
    return report.filter("rows > 0")


def column_ddl(schema: T.StructType, varchar_length: int | None = None) -> str:
    """Column list for CREATE TABLE; text columns as VARCHAR(n) when a width is given."""

    def sql_type(dtype: T.DataType) -> str:
        if varchar_length and isinstance(dtype, T.StringType):
            return f"VARCHAR({varchar_length})"
        return dtype.simpleString()

    return ", ".join(f"{quote(f.name)} {sql_type(f.dataType)}" for f in schema)
