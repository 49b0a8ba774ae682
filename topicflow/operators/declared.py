"""JSON rows that bring their own schema: ``{"schema": …, "payload": …}``.

Every payload is matched against the schema of its own row: kinds of values, ranges of
whole numbers, required fields, nested structs, lists and maps.  A row that does not match,
or has no readable schema, is invalid with the reason and the field.  Values are then read
by the merged schema of all rows, logical types included:

    Decimal     base64 of a big-endian two's-complement number   decimal(38, scale)
    Date        days since 1970-01-01                            date
    Time        milliseconds of the day                          int
    Timestamp   milliseconds since 1970-01-01                    timestamp

All of that is column expressions over the parsed payload.  Schemas are few (a producer
sends its own with each row), so they are gathered as distinct texts; beyond ``most`` of them
the operator raises.  Rows are matched by one branch per schema.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.decode import EMPTY_OBJECT, NOT_AN_OBJECT, parse_once
from topicflow.operators.evolve import merge_schemas
from topicflow.records import INVALID, add_reason

MOST_SCHEMAS = 500

# Type names and logical type names of the schema part.
DECLARED_TYPES = {
    "int8": T.ByteType(),
    "int16": T.ShortType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "float32": T.FloatType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "bytes": T.BinaryType(),
}
LOGICAL = "org.apache.kafka.connect.data."
LOGICAL_CARRIERS = {"Decimal": "bytes", "Date": "int32", "Time": "int32", "Timestamp": "int64"}
BITS = {"int8": 7, "int16": 15, "int32": 31, "int64": 63}
DAY_MILLIS = 86_400_000


@dataclass(frozen=True)
class Node:
    """One node of a declared schema."""

    kind: str
    optional: bool = False
    default: str | None = None  # as JSON
    logical: str | None = None
    scale: int = 0
    fields: tuple[tuple[str, Node], ...] = ()
    items: Node | None = None
    keys: Node | None = None

    @staticmethod
    def of(node: dict) -> Node:
        kind = node["type"]
        name = str(node.get("name") or "")
        logical = name.removeprefix(LOGICAL) if name.startswith(LOGICAL) else None
        if LOGICAL_CARRIERS.get(logical) != kind:
            logical = None
        if kind not in ("struct", "array", "map") and kind not in DECLARED_TYPES:
            raise ValueError(f"type {kind!r} is not known")
        fields = tuple((str(f["field"]), Node.of(f)) for f in node.get("fields") or ()) if kind == "struct" else ()
        if len({n for n, _ in fields}) < len(fields):
            raise ValueError("a struct names a field twice")
        scale = int((node.get("parameters") or {}).get("scale", 0)) if logical == "Decimal" else 0
        if not 0 <= scale <= 38:
            raise ValueError(f"scale {scale} is not supported")
        inner = {"array": "items", "map": "values"}.get(kind)
        return Node(
            kind,
            bool(node.get("optional")),
            None if node.get("default") is None else json.dumps(node["default"]),
            logical,
            scale,
            fields,
            Node.of(node[inner]) if inner else None,
            Node.of(node["keys"]) if kind == "map" else None,
        )

    @property
    def type(self) -> T.DataType:
        if self.kind == "struct":
            return T.StructType([T.StructField(n, f.type) for n, f in self.fields])
        if self.kind == "array":
            return T.ArrayType(self.items.type)
        if self.kind == "map":
            return T.MapType(self.keys.type, self.items.type)
        if self.logical == "Decimal":
            return T.DecimalType(38, self.scale)
        return {"Date": T.DateType(), "Timestamp": T.TimestampType()}.get(self.logical, DECLARED_TYPES[self.kind])


def declared_schema(node: dict) -> T.DataType:
    """Spark type of a declared schema."""
    return Node.of(node).type


def _step(name: str) -> str:
    if "'" not in name:
        return f"$['{name}']"
    if '"' not in name:
        return f'$["{name}"]'
    raise ValueError(f"field {name!r} holds both kinds of quotes")


def field_of(value: Column, name: str) -> Column:
    return F.try_variant_get(value, _step(name), "variant")


def _elements(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _entries(value: Column) -> Column:
    return F.map_entries(F.try_variant_get(value, "$", "map<string,variant>"))


def _absent(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value)


def _first(problems: list[Column]) -> Column:
    return F.coalesce(*problems) if problems else F.lit(None).cast("string")


def _each(values: Column, problem) -> Column:
    """The first problem of a list's elements."""
    return F.get(F.filter(F.transform(values, problem), lambda p: p.isNotNull()), F.lit(0))


def problem_of(value: Column, node: Node, path: str) -> Column:
    """What is wrong with a value, by its schema; null if nothing is."""
    missing = F.lit(None if node.optional or node.default is not None else f"required: {path}").cast("string")
    shape = F.schema_of_variant(value)
    wrong = F.lit(f"not {'an' if node.kind[0] in 'ai' else 'a'} {node.kind}: {path}")
    if node.kind == "struct":
        inner = [problem_of(field_of(value, n), f, f"{path}.{n}" if path else n) for n, f in node.fields]
        found = F.when(~shape.startswith("OBJECT"), wrong).otherwise(_first(inner))
    elif node.kind == "array":
        inner = _each(_elements(value), lambda v: problem_of(v, node.items, f"{path}[]"))
        found = F.when(~shape.startswith("ARRAY"), wrong).otherwise(inner)
    elif node.kind == "map" and node.keys.kind == "string":
        inner = _each(_entries(value), lambda e: problem_of(e["value"], node.items, f"{path}{{}}"))
        found = F.when(~shape.startswith("OBJECT"), wrong).otherwise(inner)
    elif node.kind == "map":  # a list of pairs
        def pair(v: Column) -> Column:
            both = _elements(v)
            ends = [problem_of(F.get(both, F.lit(i)), n, f"{path}{{}}") for i, n in enumerate((node.keys, node.items))]
            return F.when(F.size(both) == 2, _first(ends)).otherwise(wrong)

        found = F.when(~shape.startswith("ARRAY"), wrong).otherwise(_each(_elements(value), pair))
    else:
        found = F.when(~_fits(value, shape, node), wrong)
    return F.when(_absent(value), missing).otherwise(found)


def _fits(value: Column, shape: Column, node: Node) -> Column:
    """Whether a scalar is of the declared kind and, if a logical type, can be decoded."""
    if node.kind in BITS:
        number = F.try_variant_get(value, "$", "bigint")
        most = (1 << BITS[node.kind]) - 1
        fits = (shape == "BIGINT") & number.between(-most - 1, most)
        return fits & number.between(0, DAY_MILLIS - 1) if node.logical == "Time" else fits
    if node.kind in ("float", "float32", "double", "float64"):
        return shape.isin("BIGINT", "DOUBLE", "FLOAT") | shape.startswith("DECIMAL")
    if node.kind == "boolean":
        return shape == "BOOLEAN"
    text = F.try_variant_get(value, "$", "string")
    if node.kind == "string":
        return shape == "STRING"
    decoded = F.expr("1") if node.logical is None else _decimal(text, node.scale)
    bytes_ = F.try_to_binary(text, F.lit("base64"))
    return (shape == "STRING") & bytes_.isNotNull() & decoded.isNotNull()


def _decimal(text: Column, scale: int) -> Column:
    """base64 of a two's-complement number to a decimal; null beyond 38 digits.

    The number is widened to 16 bytes and added up from two halves of 64 bits.
    """
    digits = F.hex(F.try_to_binary(text, F.lit("base64")))
    negative = F.substring(digits, 1, 1).isin(*"89ABCDEF")
    # more than 16 bytes fit only if the rest repeats the sign
    spare = F.regexp_replace(digits, r"^(?:00)+(?=[0-7].{31})|^(?:FF)+(?=[89A-F].{31})", "")
    # of a negative number the inverted bits are its distance from -1
    inverted = F.translate(spare, "0123456789ABCDEF", "FEDCBA9876543210")
    whole = F.lpad(F.when(negative, inverted).otherwise(spare), 32, "0")
    high = F.conv(F.substring(whole, 1, 16), 16, 10).cast("decimal(38,0)")
    low = F.conv(F.substring(whole, 17, 16), 16, 10).cast("decimal(20,0)")
    number = F.try_add(F.try_multiply(high, F.lit(Decimal(1 << 64))), low).try_cast("decimal(38,0)")
    number = F.when(negative, F.try_add(number, F.lit(1))).otherwise(number).try_cast("decimal(38,0)")
    text_ = number.cast("string")
    plain = F.lpad(text_, F.greatest(F.length(text_), F.lit(scale + 1)), F.lit("0"))
    placed = F.concat(
        F.when(negative, "-").otherwise(""),
        F.substring(plain, F.lit(1), F.length(plain) - scale),
        F.lit("."),
        F.right(plain, F.lit(scale)) if scale else F.lit("0"),
    )
    ok = (F.length(digits) > 0) & (F.length(spare) <= 32)
    return F.when(ok, placed.try_cast(T.DecimalType(38, scale)))


def value_of(value: Column, node: Node) -> Column:
    """A value that matches its schema as a column of ``node.type``; the default where it is absent."""
    if node.kind == "struct":
        fields = [value_of(field_of(value, n), f).alias(n) for n, f in node.fields]
        made = F.when(~_absent(value), F.struct(*fields))
    elif node.kind == "array":
        made = F.transform(_elements(value), lambda v: value_of(v, node.items))
    elif node.kind == "map" and node.keys.kind == "string":
        made = F.map_from_entries(
            F.transform(_entries(value), lambda e: F.struct(e["key"], value_of(e["value"], node.items)))
        )
    elif node.kind == "map":
        def pair(v: Column) -> Column:
            both = _elements(v)
            return F.struct(value_of(F.get(both, F.lit(0)), node.keys), value_of(F.get(both, F.lit(1)), node.items))

        made = F.map_from_entries(F.transform(_elements(value), pair))
    else:
        made = _scalar(value, node)
    if node.default is not None:
        default = value_of(F.parse_json(F.lit(node.default)), replace(node, default=None))
        made = F.when(_absent(value), default).otherwise(made)
    return made


def _scalar(value: Column, node: Node) -> Column:
    if node.kind == "bytes":
        text = F.try_variant_get(value, "$", "string")
        return _decimal(text, node.scale) if node.logical else F.try_to_binary(text, F.lit("base64"))
    if node.logical == "Date":
        return F.date_from_unix_date(F.try_variant_get(value, "$", "int"))
    if node.logical == "Timestamp":
        return F.timestamp_millis(F.try_variant_get(value, "$", "bigint"))
    return F.try_variant_get(value, "$", node.type.simpleString())


def _merged(a: Node, b: Node) -> Node:
    """One node that reads the values of both; their types are known to merge."""
    if a.kind == "struct":
        theirs = dict(b.fields)
        fields = [(n, _merged(f, theirs.pop(n)) if n in theirs else f) for n, f in a.fields]
        return Node("struct", True, fields=(*fields, *[(n, _bare(f)) for n, f in theirs.items()]))
    items = _merged(a.items, b.items) if a.items else None
    return Node(a.kind, True, None, a.logical, a.scale, (), items, a.keys)


def _bare(node: Node) -> Node:
    """The same node without defaults."""
    fields = tuple((n, _bare(f)) for n, f in node.fields)
    return replace(node, default=None, fields=fields, items=_bare(node.items) if node.items else None)


def _with_defaults(node: Node, own: Node) -> Node:
    """The merged schema with the defaults of a row's own."""
    mine = dict(own.fields)
    fields = tuple((n, _with_defaults(f, mine[n]) if n in mine else f) for n, f in node.fields)
    items = _with_defaults(node.items, own.items) if node.items else None
    return replace(node, default=own.default, fields=fields, items=items)


@dataclass(frozen=True)
class Declared:
    """The schemas of a frame: readable ones by their text, and one to read all by."""

    by_text: dict[str, Node]
    merged: Node

    @property
    def schema(self) -> T.StructType:
        return self.merged.type


def declared_schemas(df: DataFrame, column: str = "value", most: int = MOST_SCHEMAS) -> Declared:
    """The distinct schemas of the rows; a field with two types raises ``SchemaConflict``."""
    text = F.get_json_object(F.col(column).cast("string"), "$.schema")
    distinct = df.select(text.alias("s")).filter("s is not null").distinct()
    found = sorted(r.s for r in distinct.limit(most + 1).toLocalIterator())
    if len(found) > most:
        raise ValueError(f"the rows have more than {most} declared schemas")
    by_text = dict(_readable(found))
    structs = [n for n in by_text.values() if n.kind == "struct"]
    reduce(merge_schemas, [n.type for n in structs], T.StructType())
    return Declared(by_text, reduce(_merged, structs, Node("struct", True)))


def _readable(texts: list[str]) -> Iterator[tuple[str, Node]]:
    for text in texts:
        try:
            yield text, Node.of(json.loads(text))
        except (ValueError, KeyError, TypeError, AttributeError):
            continue


NO_SCHEMA = "no readable schema"
NO_ENVELOPE = "payload has no schema and payload fields"


def decode_declared(
    df: DataFrame, column: str = "value", declared: Declared | None = None, keep_raw: str | None = None
) -> DataFrame:
    """Schema+payload rows to a struct of the merged schema; rows that do not match their own
    schema are invalid.  ``declared`` is what ``declared_schemas`` found before."""
    declared = declared_schemas(df, column) if declared is None else declared
    text = F.col(column).cast("string")
    if keep_raw:
        df = df.withColumn(keep_raw, F.col(column))
    parts = F.struct(
        F.get_json_object(text, "$.schema").alias("schema"),
        F.try_parse_json(F.get_json_object(text, "$.payload")).alias("payload"),
        F.array_sort(F.json_object_keys(text)).alias("names"),
    )
    df, row = parse_once(df, parts)
    payload = row["payload"]
    problem = F.when(row["names"].isNull(), NOT_AN_OBJECT).when(
        row["names"] != F.array(F.lit("payload"), F.lit("schema")), NO_ENVELOPE
    )
    problem = problem.when(row["schema"].isNull() | ~row["schema"].isin(*declared.by_text), NO_SCHEMA)
    groups: dict[Node, list[str]] = {}
    for schema, node in declared.by_text.items():
        groups.setdefault(node, []).append(schema)
    problem = problem.when(
        _absent(payload) | ~F.schema_of_variant(payload).startswith("OBJECT"), NOT_AN_OBJECT
    ).when(F.schema_of_variant(payload) == "OBJECT<>", EMPTY_OBJECT)
    for node, texts in groups.items():
        found = problem_of(payload, node, "") if node.kind == "struct" else F.lit(NOT_AN_OBJECT)
        problem = problem.when(row["schema"].isin(*texts), found)
    df = add_reason(df, problem)
    value = value_of(payload, declared.merged)
    for node, texts in groups.items():
        if node.kind == "struct" and _has_default(node):
            own = value_of(payload, _with_defaults(declared.merged, node))
            value = F.when(row["schema"].isin(*texts), own).otherwise(value)
    value = F.when(F.size(INVALID) == 0, value).cast(declared.schema)
    return df.withColumn(column, value).drop("__parsed")


def _has_default(node: Node) -> bool:
    inner = [f for _, f in node.fields] + [n for n in (node.items, node.keys) if n]
    return node.default is not None or any(map(_has_default, inner))
