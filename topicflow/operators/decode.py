"""Payload decoding: JSON with or without a schema, XML, Avro, Protobuf.

Decoders turn the text or binary column ``value`` into a struct.  Rows that
cannot be decoded, or whose payload is not a filled object, keep a null record
and get a reason in ``_invalid``; the original payload stays in ``raw`` when
``keep_raw`` names a column for it.
"""

from __future__ import annotations

import json
import re
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.infer import MIXED, MIXED_EMPTY_KEY, infer_schema
from topicflow.records import INVALID, add_reason
from topicflow.session import materialise

CORRUPT = "_corrupt_payload"
PARSED = "__parsed"
FORM = "__form"
EMPTY_KEY = "empty key"
NOT_AN_OBJECT = "payload is not an object"
EMPTY_OBJECT = "payload is an empty object"


def drop_tombstones(df: DataFrame, column: str = "value") -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def require_object(df: DataFrame, column: str = "value") -> DataFrame:
    """Flag payloads that are not a JSON object with at least one key."""
    text = F.col(column).cast("string")
    keys = F.json_object_keys(text)
    problem = (
        F.when(keys.isNull() & text.rlike(r"^\s*\{"), "malformed payload")
        .when(keys.isNull(), NOT_AN_OBJECT)
        .when(F.size(keys) == 0, EMPTY_OBJECT)
    )
    return add_reason(df, problem)


def _is_mixed(field: T.StructField) -> bool:
    return bool((field.metadata or {}).get(MIXED))


def _parse_schema(schema: T.StructType) -> T.StructType:
    """What the parser is told: mixed fields as variants, empty keys as text."""
    fields = []
    for f in schema:
        dtype = f.dataType
        if _is_mixed(f):
            dtype = T.VariantType()
        elif f.name == "":
            # any value under an empty key makes the row invalid
            dtype = T.StringType()
        elif isinstance(dtype, T.StructType):
            dtype = _parse_schema(dtype)
        fields.append(T.StructField(f.name, dtype))
    return T.StructType(fields)


def _with_empty_keys(schema: T.StructType) -> T.StructType:
    """The schema with a helper field under the empty key of every object."""
    fields = []
    for f in schema:
        if isinstance(f.dataType, T.StructType) and not _is_mixed(f):
            f = T.StructField(f.name, _with_empty_keys(f.dataType), True, f.metadata)
        fields.append(f)
    if "" not in schema.names:
        fields.append(T.StructField("", T.StringType()))
    return T.StructType(fields)


def _empty_keys(c: Column, schema: T.StructType) -> list[Column]:
    """For every object that may hold an empty key, whether it does."""
    found = []
    for f in schema:
        inner = c.getField(f.name)
        if _is_mixed(f):
            if f.metadata.get(MIXED_EMPTY_KEY):
                value = F.try_variant_get(inner, _member(""), "variant")
                found.append(value.isNotNull() & ~F.is_variant_null(value))
        elif f.name == "":
            found.append(inner.isNotNull())
        elif isinstance(f.dataType, T.StructType):
            found += _empty_keys(inner, f.dataType)
    return found


def _member(name: str) -> str:
    return f"$['{name}']" if "'" not in name else f'$["{name}"]'


def _from_variant(c: Column, field: T.StructField) -> Column:
    dtype = field.dataType
    if not isinstance(dtype, T.StructType):
        return F.try_variant_get(c, "$", dtype.simpleString())
    shape = F.schema_of_variant(c)
    filled = shape.startswith("OBJECT<") & (shape != "OBJECT<>")
    fields = []
    for f in dtype:
        if f.name == "":
            value = F.when(~filled, F.try_variant_get(c, "$", f.dataType.simpleString()))
        else:
            value = _from_variant(F.try_variant_get(c, _member(f.name), "variant"), f)
        fields.append(value.alias(f.name))
    return F.when(c.isNotNull(), F.struct(*fields))


def _record(c: Column, schema: T.StructType) -> Column:
    """The parsed record without helper fields."""
    fields = []
    for f in schema:
        inner = c.getField(f.name)
        if _is_mixed(f):
            fields.append(_from_variant(inner, f).alias(f.name))
        elif f.name != "":
            if isinstance(f.dataType, T.StructType) and _needs_work(f.dataType):
                inner = _record(inner, f.dataType)
            fields.append(inner.alias(f.name))
    return F.when(c.isNotNull(), F.struct(*fields))


def _needs_work(schema: T.StructType) -> bool:
    return any(
        f.name == "" or _is_mixed(f) or (isinstance(f.dataType, T.StructType) and _needs_work(f.dataType))
        for f in schema
    )


def _all_null(record: Column, schema: T.StructType) -> Column:
    nothing = F.lit(True)
    for f in schema:
        nothing = nothing & record.getField(f.name).isNull()
    return nothing


def parse_once(df: DataFrame, parsed: Column) -> tuple[DataFrame, Column]:
    """Add the parsed record so that later filters do not parse it again.

    A filter on a plain projected column is pushed below the projection, with
    the whole parse inside it; a generator is evaluated once and stays put.
    """
    return df.select("*", F.explode(F.array(parsed)).alias(PARSED)), F.col(PARSED)


def decode_json(
    df: DataFrame,
    schema: T.StructType | None = None,
    column: str = "value",
    discard_collections: bool = False,
    keep_raw: str | None = None,
    mixed: bool = False,
) -> DataFrame:
    """JSON text to a struct.  Without ``schema`` it is inferred from all rows.

    Inference is strict: a field with two types raises ``SchemaConflict``; see
    ``schema_epochs`` for payloads that change type along the topic.  With
    ``mixed`` a field may be an object in some rows and a plain value in
    others; flattening gives each its own column.
    """
    if schema is None:
        schema = infer_schema(df, column, discard_collections, mixed=mixed)
    else:
        schema = _with_empty_keys(schema)
    text = F.col(column).cast("string")
    if keep_raw:
        df = df.withColumn(keep_raw, F.col(column))
    declared = T.StructType([*_parse_schema(schema), T.StructField(CORRUPT, T.StringType())])
    # the option also keeps the optimiser from narrowing the parse schema,
    # which would hide type errors in fields a query does not select
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    df, record = parse_once(df, F.from_json(text, declared, options))

    corrupt = record.getField(CORRUPT).isNotNull()
    problem = (
        F.when(corrupt & ~text.rlike(r"^\s*\{"), NOT_AN_OBJECT)
        .when(corrupt, "payload does not match the schema")
        .when(_all_null(record, schema) & text.rlike(r"^\s*\{\s*\}"), EMPTY_OBJECT)
    )
    for flag in _empty_keys(record, schema):
        problem = problem.when(flag, EMPTY_KEY)
    df = add_reason(df, problem)
    value = F.when(F.size(INVALID) == 0, _record(record, schema))
    return df.withColumn(column, value).drop(PARSED)


def compact_json(text: Column) -> Column:
    """The same JSON value without white space, key order kept."""
    return F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string").getField("v")


# ---------------------------------------------------------------- XML

# Fixed value: the attribute that marks an element as null.
NIL = "{http://www.w3.org/2001/XMLSchema-instance}nil"


# Made once: compact JSON, characters as they are.
to_text = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")).encode


def _local(name: str) -> str:
    return name.rpartition("}")[2] if name[0] == "{" else name


def _element_value(element):
    """Text of a leaf, else its attributes and children; repeats become a list."""
    if not len(element) and not element.attrib:
        return element.text or ""
    if element.get(NIL) == "true":
        return None
    fields: dict = {}
    repeated: set[str] = set()

    def add(name: str, value) -> None:
        if name not in fields:
            fields[name] = value
        elif name in repeated:
            fields[name].append(value)
        else:
            fields[name] = [fields[name], value]
            repeated.add(name)

    for name, value in element.attrib.items():
        add(_local(name), value)
    loose = element.text or ""
    for child in element:
        add(_local(child.tag), _element_value(child))
        if child.tail:
            loose += child.tail
    if loose and not loose.isspace():
        # text beside attributes or children has no name of its own
        fields[""] = loose
    return fields


def _document_json(text: str | None) -> str | None:
    if text is None:
        return None
    try:
        return to_text(_element_value(ElementTree.fromstring(text)))
    except ElementTree.ParseError:
        return None


class XmlTemplates:
    """JSON of XML documents; those that differ in plain values only are parsed once.

    A plain value is text or an attribute's text, or a part of it, that starts with no space
    and holds no markup, quote, backslash or control character.  Such values come out as
    they went in, so the JSON of a document with marks in their places serves for all
    documents that are equal but for them.  A document with anything special is parsed.
    """

    OPEN, CLOSE = "\ue000", "\ue001"
    KEPT = 1000
    LONGEST = 10_000
    MARK = re.compile(f"{OPEN}([0-9]+){CLOSE}")
    _NOT = r"<>\"'&\\\\\x00-\x1f\ud800-\udfff\ufffe\uffff"
    VALUE = re.compile(f'(?<=[">])([^\\s{_NOT}][^{_NOT}]*)(?=["<])')
    SPECIAL = ("<!", "<?", "xmlns", OPEN, CLOSE)

    def __init__(self) -> None:
        #: By what is around the values: None when met once, then the template.
        self.known: dict[str, tuple[str, tuple[int, ...] | None, str] | None] = {}

    def json(self, text: str | None) -> str | None:
        return self.json_and_form(text)[0]

    def json_and_form(self, text: str | None) -> tuple[str | None, str | None]:
        """The JSON, and where a template made it the JSON without the values."""
        if text is None or len(text) > self.LONGEST:
            return _document_json(text), None
        for special in self.SPECIAL:
            if special in text:
                return _document_json(text), None
        parts = self.VALUE.split(text)
        around, values = self.OPEN.join(parts[::2]), parts[1::2]
        found = self.known.get(around)
        if found is None:
            # one that was met only once is not worth a template
            if len(self.known) >= self.KEPT:
                self.known.clear()
            found = self.known[around] = self.template(parts[::2]) if around in self.known else None
            if found is None:
                return _document_json(text), None
        whole, order, form = found
        return whole % (tuple(values) if order is None else tuple([values[i] for i in order])), form

    def template(self, around: list[str]) -> tuple[str, tuple[int, ...] | None, str] | None:
        """Format of the JSON, the order of the values in it, and the JSON without them."""
        marked = [f"{part}{self.OPEN}{i}{self.CLOSE}" for i, part in enumerate(around[:-1])]
        found = _document_json("".join(marked) + around[-1])
        if found is None:
            return None
        parts = self.MARK.split(found)
        order = [int(i) for i in parts[1::2]]
        if sorted(order) != list(range(len(around) - 1)):
            return None
        whole = "%s".join(p.replace("%", "%%") for p in parts[::2])
        return whole, None if order == sorted(order) else tuple(order), "".join(parts[::2])


@F.pandas_udf(T.StringType())
def xml_to_json(text: pd.Series) -> pd.Series:
    """JSON text of XML documents; null where a document is malformed.

    Spark's own ``from_xml`` has no way to express lists that mix text and
    elements, nor text beside attributes, so Arrow batches go through Python.
    """
    of = XmlTemplates().json
    return pd.Series([of(t) for t in text], text.index, object)


@F.pandas_udf(T.StructType().add("json", T.StringType()).add("form", T.StringType()))
def xml_to_json_and_form(text: pd.Series) -> pd.DataFrame:
    """As ``xml_to_json``, with what ``XmlTemplates`` knows to have the same fields and types."""
    of = XmlTemplates().json_and_form
    found = [of(t) for t in text]
    columns = {"json": [json for json, _ in found], "form": [form for _, form in found]}
    return pd.DataFrame(columns, text.index, dtype=object)


# plain functions could be pushed into filters and then run twice per row
xml_to_json = xml_to_json.asNondeterministic()
xml_to_json_and_form = xml_to_json_and_form.asNondeterministic()


def _infer_xml(df: DataFrame, column: str, **how: bool) -> T.StructType:
    """Schema of JSON in ``column``; rows of one ``FORM`` have one shape, so each counts once."""
    first = (F.col("offset") if "offset" in df.columns else F.lit(0)).cast("bigint")
    rows = df.select(F.col(column).alias("value"), FORM, first.alias("offset"))
    forms = rows.filter(F.col(FORM).isNotNull()).groupBy(F.col(FORM).alias("value")).agg(F.min("offset").alias("offset"))
    return infer_schema(forms.unionByName(rows.filter(F.col(FORM).isNull()).drop(FORM)), **how)


def decode_xml(
    df: DataFrame,
    schema: T.StructType | None = None,
    column: str = "value",
    discard_collections: bool = False,
    keep_raw: str | None = None,
    mixed: bool = False,
) -> DataFrame:
    """XML text to a struct of text fields.

    The root element is dropped, attributes are fields like child elements, and
    repeats form a list even when they do not stand together; a list is kept as
    JSON text.  Text beside attributes or children falls under an empty key,
    which makes the row invalid.
    """
    if keep_raw:
        df = df.withColumn(keep_raw, F.col(column))
    if schema is None:
        # inference and decoding both read the JSON, so make it once
        both = xml_to_json_and_form(F.col(column).cast("string"))
        df = df.withColumn(FORM, both)
        df = materialise(df.withColumns({column: F.col(FORM)["json"], FORM: F.col(FORM)["form"]}))
        schema = _infer_xml(df, column, discard_collections=discard_collections, mixed=mixed)
        df = df.drop(FORM)
    else:
        df = df.withColumn(column, xml_to_json(F.col(column).cast("string")))
    df = add_reason(df, F.when(F.col(column).isNull(), F.lit("malformed XML")))
    return decode_json(df, schema, column, discard_collections, mixed=mixed)


# ---------------------------------------------------------------- Avro, Protobuf


def decode_avro(df: DataFrame, schema_json: str, column: str = "value") -> DataFrame:
    """Avro bytes with a known schema; needs Spark's own Avro module on the classpath."""
    from pyspark.sql.avro.functions import from_avro

    parsed = from_avro(F.col(column), schema_json, {"mode": "PERMISSIVE"})
    df, record = parse_once(df, parsed)
    df = add_reason(df, F.when(record.isNull(), F.lit("malformed Avro")))
    return df.withColumn(column, record).drop(PARSED)


def decode_protobuf(
    df: DataFrame, message: str, descriptor_file: str, column: str = "value"
) -> DataFrame:
    """Protobuf bytes; needs Spark's own Protobuf module on the classpath."""
    from pyspark.sql.protobuf.functions import from_protobuf

    parsed = from_protobuf(F.col(column), message, descriptor_file, {"mode": "PERMISSIVE"})
    df, record = parse_once(df, parsed)
    df = add_reason(df, F.when(record.isNull(), F.lit("malformed Protobuf")))
    return df.withColumn(column, record).drop(PARSED)
