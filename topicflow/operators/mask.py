"""Mask text fields at any depth."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.functions import masking
from topicflow.records import at, quote, record_schema

# Fixed value: the path step that stands for "every element of this list".
ELEMENT = "value"


@dataclass(frozen=True)
class Mask:
    """Which fields to mask and how: ``fix``, ``sha1`` or ``sha512``."""

    fields: tuple[str, ...]
    method: str = "fix"
    salt: str | None = None
    random_salt: bool = False

    def __post_init__(self) -> None:
        names = self.fields.split(",") if isinstance(self.fields, str) else self.fields
        distinct = tuple(dict.fromkeys(n.strip() for n in names if n.strip()))
        if not distinct:
            raise ValueError("no fields to mask were given")
        object.__setattr__(self, "fields", distinct)
        object.__setattr__(self, "method", self.method.lower())
        if self.method not in ("fix", "sha1", "sha512"):
            raise ValueError(f"unknown mask {self.method!r}: use fix, sha1 or sha512")
        if self.method == "sha512" and self.salt is None and not self.random_salt:
            raise ValueError("sha512 needs a salt or random_salt=True")

    def expression(self) -> Callable[[Column, Column], Column]:
        """(value, text that differs for every value) -> masked value."""
        if self.method == "fix":
            return lambda c, _: masking.mask_fixed(c)
        if self.method == "sha1":
            return lambda c, _: masking.mask_sha1(c)
        if self.salt is not None:
            return lambda c, _: masking.mask_sha512(c, self.salt)
        return masking.mask_sha512_random


def _steps(paths: Iterable[str]) -> list[tuple[str, ...]]:
    return [tuple(p.split(".")) for p in paths]


def _masked(
    c: Column, dtype: T.DataType, rests: list[tuple[str, ...]], seed: Column, mask, where: str
) -> Column:
    """Mask inside ``c``; ``rests`` are the path steps still to take."""
    if isinstance(dtype, T.StringType):
        if len(rests) > 1:
            raise ValueError(f"several paths end at the text field {where}")
        if rests[0]:
            raise ValueError(f"{where} is a text field, so {'.'.join(rests[0])} cannot be below it")
        return mask(c, F.concat_ws("/", seed, F.lit(where)))
    if isinstance(dtype, T.StructType):
        if any(not r for r in rests):
            raise ValueError(f"{where} is an object and cannot be masked as a whole")
        for field in dtype:
            below = [r[1:] for r in rests if r[0] == field.name]
            if below:
                inner = _masked(
                    c.getField(field.name), field.dataType, below, seed, mask, f"{where}.{field.name}"
                )
                c = c.withField(quote(field.name), inner)
        return c
    if isinstance(dtype, T.ArrayType):
        if any(not r or r[0] != ELEMENT for r in rests):
            raise ValueError(f"{where} is a list: its path must go on with {ELEMENT!r}")
        below = [r[1:] for r in rests]
        if any(below) and not all(below):
            raise ValueError(f"overlapping paths inside the list {where}")
        return F.transform(
            c,
            lambda e, i: _masked(
                e, dtype.elementType, below, F.concat_ws("/", seed, i.cast("string")), mask,
                f"{where}.{ELEMENT}",
            ),
        )
    raise ValueError(f"{where} is {dtype.simpleString()}: only text can be masked")


def apply_mask(df: DataFrame, mask: Mask, column: str | None = None) -> DataFrame:
    """Mask every path of ``mask`` that exists; bad paths raise before any job runs."""
    schema = record_schema(df, column)
    paths = _steps(mask.fields)
    expression = mask.expression()
    changed = {}
    for field in schema:
        below = [p[1:] for p in paths if p[0] == field.name]
        if below:
            c = at(column, [field.name])
            # one random text per row; path and list position make it one per value
            seed = F.expr("uuid()") if mask.random_salt and mask.salt is None else F.lit("")
            changed[field.name] = _masked(c, field.dataType, below, seed, expression, field.name)
    if not changed:
        return df
    if column is None:
        return df.withColumns(changed)
    record = at(column, ())
    for name, c in changed.items():
        record = record.withField(quote(name), c)
    return df.withColumn(column, record)


def mask(
    df: DataFrame,
    fields: Iterable[str] | str,
    method: str = "fix",
    salt: str | None = None,
    random_salt: bool = False,
    column: str | None = None,
) -> DataFrame:
    return apply_mask(df, Mask(fields, method, salt, random_salt), column)
