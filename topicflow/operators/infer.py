"""Strict schema inference for payloads that carry no schema.

Each distinct row shape is reduced to (path, type) pairs on the executors, so
the driver only ever sees as many rows as the resulting schema has fields.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.evolve import SchemaConflict
from topicflow.session import keep_last_of_repeated_keys

# The variant type names that stand for each inferred type.
# Every number that is not a whole one fitting a long is a double; a list is
# kept as JSON text; an empty object is the text {}.
LEAF_TYPES = {
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "FLOAT": "double",
    "DECIMAL": "double",
    "BOOLEAN": "boolean",
    "STRING": "string",
    "ARRAY": "list",
}
SPARK_TYPES = {
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "list": T.StringType(),
    "empty": T.StringType(),
}


def _without_precision(shape: Column) -> Column:
    return F.when(
        shape.contains("DECIMAL("), F.regexp_replace(shape, r"DECIMAL\(\d+,\d+\)", "DECIMAL")
    ).otherwise(shape)


def json_shape(text: Column) -> Column:
    """Shape of one JSON value, e.g. ``OBJECT<a: BIGINT, b: OBJECT<c: STRING>>``."""
    return _without_precision(F.schema_of_variant(F.try_parse_json(text)))


def shape_fields(shape: str) -> list[tuple[list[str], str]]:
    """(path, type) pairs of an object shape; nulls are not part of a schema."""
    found: list[tuple[list[str], str]] = []
    pos = len("OBJECT<")

    def name() -> str:
        nonlocal pos
        if shape[pos] != "`":
            end = shape.index(": ", pos)
            text, pos = shape[pos:end], end
            return text
        start = pos = pos + 1
        while True:
            pos = shape.index("`", pos)
            if shape[pos : pos + 2] != "``":
                break
            pos += 2
        text = shape[start:pos].replace("``", "`")
        pos += 1
        return text

    def skip_list() -> None:
        """Move past ``ARRAY<…>``; quoted names may hold brackets."""
        nonlocal pos
        depth = 0
        while True:
            ch = shape[pos]
            if ch == "`":
                pos = shape.index("`", pos + 1)
            depth += (ch == "<") - (ch == ">")
            pos += 1
            if depth == 0 and ch == ">":
                return

    def fields(path: list[str]) -> None:
        nonlocal pos
        while shape[pos] != ">":
            here = [*path, name()]
            pos += 2
            if shape.startswith("OBJECT<>", pos):
                found.append((here, "empty"))
                pos += len("OBJECT<>")
            elif shape.startswith("OBJECT<", pos):
                found.append((here, "struct"))
                pos += len("OBJECT<")
                fields(here)
                pos += 1
            elif shape.startswith("ARRAY<", pos):
                found.append((here, "list"))
                pos += len("ARRAY")
                skip_list()
            else:
                end = pos
                while shape[end] not in ",>":
                    end += 1
                kind = LEAF_TYPES.get(shape[pos:end])
                if kind:
                    found.append((here, kind))
                pos = end
            if shape.startswith(", ", pos):
                pos += 2

    if shape.startswith("OBJECT<"):
        fields([])
    return found


def _fields_of_shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = [
            (path, kind, first, rows)
            for shape, first, rows in zip(batch["shape"], batch["first"], batch["rows"])
            for path, kind in shape_fields(shape)
        ]
        yield pd.DataFrame(out, columns=["path", "type", "first", "rows"])


def row_shapes(df: DataFrame, column: str = "value", order: Column | None = None) -> DataFrame:
    """(shape, first, rows): distinct object shapes, combined on the map side.

    ``first`` is the lowest ``order`` (by default the offset, if there is one).
    A repeated key inside one object keeps its last value, as in the decoder.
    """
    keep_last_of_repeated_keys(df.sparkSession)
    if order is None:
        order = F.col("offset") if "offset" in df.columns else F.lit(0)
    text = F.col(column).cast("string")
    raw = F.schema_of_variant(F.try_parse_json(text))
    distinct = (
        df.select(raw.alias("shape"), order.cast("bigint").alias("first"))
        .filter(F.col("shape").startswith("OBJECT<"))
        .groupBy("shape")
        .agg(F.min("first").alias("first"), F.count("*").alias("rows"))
    )
    # the pattern runs on distinct shapes, not on every row
    return distinct.groupBy(_without_precision(F.col("shape")).alias("shape")).agg(
        F.min("first").alias("first"), F.sum("rows").alias("rows")
    )


def fields_of(shapes: DataFrame) -> DataFrame:
    """(path, type, first, rows) of shapes, worked out on the executors."""
    return (
        shapes.mapInPandas(
            _fields_of_shapes, "path array<string>, type string, first bigint, rows bigint"
        )
        .groupBy("path", "type")
        .agg(F.min("first").alias("first"), F.sum("rows").alias("rows"))
    )


def field_types(df: DataFrame, column: str = "value", order: Column | None = None) -> DataFrame:
    """(path, type, first, rows): every type seen at every path, as a small frame."""
    return fields_of(row_shapes(df, column, order))


#: Fields that the driver takes; payloads that use ids as keys have as many as ids.
MOST_FIELDS = 50_000


def bounded(rows: DataFrame, most: int = MOST_FIELDS, what: str = "fields") -> list:
    """All rows on the driver, or an error if there are more than ``most``."""
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"the payloads have more than {most} {what}; json_chunks takes any keys")
    return found


def collect_fields(df: DataFrame, column: str = "value", order: Column | None = None) -> list:
    """(path, type, first, rows) on the driver; as many as the schema has fields."""
    return bounded(field_types(df, column, order))


# Metadata of a field that is an object in some rows and a plain value in
# others: a struct whose field with the empty name holds the plain value.
MIXED = "mixed"
MIXED_EMPTY_KEY = "mixed_empty_key"


def schema_from_fields(
    rows: list,
    discard_collections: bool = False,
    widen_numbers: bool = False,
    mixed: bool = False,
) -> T.StructType:
    """Fold (path, type, first, rows) into one schema; two types at a path raise.

    A list beside text is fine, both are text.  An empty object beside a filled
    one has no fields to add.  With ``mixed``, meant for records that will be
    flattened, an object may stand beside a plain value: their columns have
    different names, so they do not conflict.
    """
    kinds: dict[tuple[str, ...], dict[str, int]] = {}
    for row in rows:
        if not (discard_collections and row["type"] == "list"):
            seen = kinds.setdefault(tuple(row["path"]), {})
            seen[row["type"]] = min(row["first"], seen.get(row["type"], row["first"]))

    def resolve(path: tuple[str, ...], leave_out: str = "") -> str:
        seen = {k: v for k, v in kinds[path].items() if k != leave_out}
        if "struct" in seen:
            seen.pop("empty", None)
        if {"bigint", "double"} <= set(seen) and widen_numbers:
            first = min(seen.pop("bigint"), seen.pop("double"))
            seen["double"] = first
        spark = {}
        for kind, first in sorted(seen.items(), key=lambda kv: (kv[1], kv[0])):
            spark.setdefault("struct" if kind == "struct" else SPARK_TYPES[kind].simpleString(), kind)
        if len(spark) > 1:
            previous, current = list(spark)[:2]
            raise SchemaConflict(".".join(path), previous, current)
        return next(iter(spark.values()))

    children: dict[tuple[str, ...], list[tuple[int, str]]] = {}
    for path, seen in kinds.items():
        children.setdefault(path[:-1], []).append((min(seen.values()), path[-1]))

    def build(path: tuple[str, ...]) -> T.StructType:
        fields = []
        for _, name in sorted(children.get(path, [])):
            here = (*path, name)
            if name == "":
                # the decoder rejects rows that fill it, so its type is no matter
                fields.append(T.StructField(name, T.StringType()))
                continue
            if mixed and "struct" in kinds[here] and len(kinds[here]) > 1 and build(here).fields:
                fields.append(mixed_field(here))
                continue
            kind = resolve(here)
            dtype = build(here) if kind == "struct" else SPARK_TYPES[kind]
            if not (isinstance(dtype, T.StructType) and not dtype.fields):
                fields.append(T.StructField(name, dtype))
        return T.StructType(fields)

    def mixed_field(path: tuple[str, ...]) -> T.StructField:
        plain = T.StructField("", SPARK_TYPES[resolve(path, leave_out="struct")])
        inner = [f for f in build(path) if f.name != ""]
        metadata = {MIXED: True, MIXED_EMPTY_KEY: (*path, "") in kinds}
        return T.StructField(path[-1], T.StructType([plain, *inner]), True, metadata)

    return build(())


def infer_schema(
    df: DataFrame,
    column: str = "value",
    discard_collections: bool = False,
    order: Column | None = None,
    widen_numbers: bool = False,
    mixed: bool = False,
) -> T.StructType:
    """The union of all row schemas: fields in order of first appearance, then name.

    Long against double is a conflict unless ``widen_numbers``.
    """
    fields = collect_fields(df, column, order)
    return schema_from_fields(fields, discard_collections, widen_numbers, mixed)


def schema_conflicts(df: DataFrame, column: str = "value", order: Column | None = None) -> DataFrame:
    """(field, type, first_offset, rows) for every field seen with more than one type."""
    spark_type = F.when(F.col("type").isin("list", "empty"), "string").otherwise(F.col("type"))
    types = (
        field_types(df, column, order)
        .groupBy("path", spark_type.alias("type"))
        .agg(F.min("first").alias("first_offset"), F.sum("rows").alias("rows"))
    )
    several = types.groupBy("path").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    return types.join(several, "path").select(
        F.array_join("path", ".").alias("field"), "type", "first_offset", "rows"
    )
