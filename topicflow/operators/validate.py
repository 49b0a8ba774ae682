"""Key checks and the split into valid rows and dead letters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.records import INVALID, add_reason, at, record_schema


def check_key_names(keys: list[str]) -> None:
    """Letters, digits or underscore, not starting with a digit."""
    for key in keys:
        if not re.fullmatch(r"[^\W\d]\w*", key):
            raise ValueError(f"{key!r} is not a valid key name")


def key_problem(
    df: DataFrame, keys: list[str], allow_null: bool = False, column: str | None = None
) -> Column:
    """Reason text, or null when the keys of the row are fine."""
    names = set(record_schema(df, column).names)
    missing = [k for k in keys if k not in names]
    if missing:
        return F.lit("missing key: " + ",".join(missing))
    if allow_null or not keys:
        return F.lit(None).cast("string")
    nulls = F.concat_ws(",", *[F.when(at(column, [k]).isNull(), F.lit(k)) for k in keys])
    return F.when(nulls != "", F.concat(F.lit("null key: "), nulls))


def validate_keys(
    df: DataFrame, keys: list[str], allow_null: bool = False, column: str | None = None
) -> DataFrame:
    check_key_names(keys)
    return add_reason(df, key_problem(df, keys, allow_null, column))


def validate_widths(df: DataFrame, length: int, column: str | None = None) -> DataFrame:
    """Flag rows with a text of more than ``length`` characters in a top-level field."""
    names = [f.name for f in record_schema(df, column) if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    long = [F.when(F.length(at(column, [n])) > length, F.lit(f"longer than {length}: {n}")) for n in names]
    return add_reason(df, F.coalesce(*long))


def split_invalid(df: DataFrame, continue_on_invalid: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, dead letters).  Without ``continue_on_invalid`` the first invalid
    row fails the job that reads the valid frame."""
    bad = F.size(INVALID) > 0
    dead = df.filter(bad).withColumn("reason", F.array_join(INVALID, "; ")).drop(INVALID)
    if continue_on_invalid:
        return df.filter(~bad).drop(INVALID), dead
    checked = df.filter(
        F.when(bad, F.raise_error(F.concat(F.lit("invalid row: "), F.array_join(INVALID, "; "))).cast("boolean"))
        .otherwise(F.lit(True))
    )
    return checked.drop(INVALID), dead
