"""Rows with a schema of their own: matching, logical types, defaults."""

import base64
import datetime
import json
from decimal import Context, Decimal

import pytest
from pyspark.sql import types as T

from topicflow.operators.declared import Node, declared_schemas, decode_declared
from topicflow.operators.evolve import SchemaConflict


def field(title, kind, **more):
    return {"field": title, "type": kind, **more}


def struct(*fields, **more):
    return {"type": "struct", "fields": list(fields), **more}


def row(schema, payload):
    return json.dumps({"schema": schema, "payload": payload})


def logical(title, kind, which, **more):
    return field(title, kind, name=f"org.apache.kafka.connect.data.{which}", **more)


def decoded(topic, texts):
    out = decode_declared(topic(texts)).orderBy("offset").collect()
    return [r["_invalid"][0] if r["_invalid"] else r["value"].asDict(True) for r in out]


BERTH = struct(
    field("ship", "string"), field("crew", "int16"), field("pilot", "boolean", optional=True),
    field("draught", "double", optional=True),
)


@pytest.mark.parametrize(
    "payload,problem",
    [
        ({"ship": "Ida", "crew": 9, "pilot": True, "draught": 4}, None),
        ({"ship": "Ida", "crew": -32768}, None),
        ({"ship": "Ida", "crew": 9, "pilot": None, "draught": 4.25, "more": [1]}, None),
        ({"ship": 5, "crew": 9}, "not a string: ship"),
        ({"ship": {"x": 1}, "crew": 9}, "not a string: ship"),
        ({"ship": "Ida", "crew": "9"}, "not an int16: crew"),
        ({"ship": "Ida", "crew": 32768}, "not an int16: crew"),
        ({"ship": "Ida", "crew": 9.5}, "not an int16: crew"),
        ({"ship": "Ida", "crew": 9, "pilot": "true"}, "not a boolean: pilot"),
        ({"ship": "Ida", "crew": 9, "draught": "4"}, "not a double: draught"),
        ({"ship": "Ida"}, "required: crew"),
        ({"ship": None, "crew": 1}, "required: ship"),
        ([1], "payload is not an object"),
        (None, "payload is not an object"),
        ({}, "payload is an empty object"),
    ],
)
def test_values_are_matched_against_the_row_s_schema(topic, payload, problem):
    (found,) = decoded(topic, [row(BERTH, payload)])
    if problem:
        assert found == problem
    else:
        assert found == {n: payload.get(n) for n in ("ship", "crew", "pilot", "draught")}


def test_rows_without_a_schema_are_invalid(topic):
    texts = [
        row(BERTH, {"ship": "a", "crew": 1}), '{"payload":{"ship":"a"}}', '{"ship":"a","crew":1}', "[1]", '"x"', "{",
        row(None, {"ship": "a"}), row("BERTH", {"ship": "a"}), row({"type": "number"}, {"ship": "a"}),
        row({"type": "string"}, "x"), '{"schema":{"type":"struct"},"payload":{"a":1},"extra":2}',
    ]
    found = decoded(topic, texts)
    assert found[0]["ship"] == "a"
    assert found[1:] == [
        "payload has no schema and payload fields", "payload has no schema and payload fields",
        "payload is not an object", "payload is not an object", "payload is not an object",
        "no readable schema", "no readable schema", "no readable schema", "payload is not an object",
        "payload has no schema and payload fields",
    ]


def test_each_row_has_its_own_schema_and_all_share_one_type(topic):
    old = struct(field("id", "int64"), field("note", "string"))
    new = struct(field("id", "int64"), field("note", "string", optional=True), field("flag", "boolean", default=True))
    texts = [row(old, {"id": 1}), row(new, {"id": 2}), row(old, {"id": 3, "note": "x"}), row(new, {"id": 4, "flag": False})]
    assert decoded(topic, texts) == [
        "required: note",
        {"id": 2, "note": None, "flag": True},
        {"id": 3, "note": "x", "flag": None},
        {"id": 4, "note": None, "flag": False},
    ]
    with pytest.raises(SchemaConflict):
        declared_schemas(topic([row(old, {}), row(struct(field("id", "string")), {})]))
    with pytest.raises(ValueError, match="more than 1"):
        declared_schemas(topic(texts), most=1)


def test_nested_values(topic):
    inner = struct(field("n", "int32"), field("t", "string", optional=True))
    schema = struct(
        {**inner, "field": "one", "optional": True},
        field("many", "array", items=inner, optional=True),
        field("by_name", "map", keys={"type": "string"}, values=inner, optional=True),
        field("by_number", "map", keys={"type": "int32"}, values={"type": "string", "optional": True}, optional=True),
        field("it's", "string", optional=True),
    )
    texts = [
        row(schema, {"one": {"n": 1}, "many": [{"n": 2, "t": "x"}, {"n": 3}], "by_name": {"k": {"n": 4}},
                     "by_number": [[7, "seven"], [8, None]], "it's": "q"}),
        row(schema, {"many": []}),
        row(schema, {"one": {"t": "x"}}),
        row(schema, {"many": [{"n": 2}, {"t": "x"}]}),
        row(schema, {"many": {"n": 2}}),
        row(schema, {"many": [{"n": 2}, None]}),
        row(schema, {"by_name": {"k": {"n": "4"}}}),
        row(schema, {"by_number": [["7", "x"]]}),
        row(schema, {"by_number": [[7]]}),
    ]
    found = decoded(topic, texts)
    assert found[0] == {
        "one": {"n": 1, "t": None}, "many": [{"n": 2, "t": "x"}, {"n": 3, "t": None}],
        "by_name": {"k": {"n": 4, "t": None}}, "by_number": {7: "seven", 8: None}, "it's": "q",
    }
    assert found[1]["many"] == [] and found[1]["one"] is None
    assert found[2:] == [
        "required: one.n", "required: many[].n", "not an array: many", "required: many[]", "not an int32: by_name{}.n",
        "not an int32: by_number{}", "not a map: by_number",
    ]


def two_s_complement(number):
    size = max(1, (number.bit_length() + 8) // 8)
    return base64.b64encode(number.to_bytes(size, "big", signed=True)).decode()


NUMBERS = [
    0, 1, -1, 127, 128, -128, -129, 255, 12345, -98765, 2**63 - 1, 2**63, -(2**63), -(2**63) - 1, 2**64, -(2**64),
    10**37, -(10**37), 10**38 - 1, -(10**38) + 1,
]


@pytest.mark.parametrize("scale", [0, 2, 5])
def test_decimals(topic, scale):
    schema = struct(logical("d", "bytes", "Decimal", parameters={"scale": str(scale)}))
    texts = [row(schema, {"d": two_s_complement(n)}) for n in NUMBERS]
    texts += [row(schema, {"d": base64.b64encode(b"\0" * 9 + b"\x05").decode()})]
    texts += [row(schema, {"d": base64.b64encode(b"\xff" * 20).decode()})]
    found = decoded(topic, texts)
    wanted = [Decimal(n).scaleb(-scale, Context(prec=60)) for n in [*NUMBERS, 5, -1]]
    assert found == [{"d": w} for w in wanted]
    for bad in (two_s_complement(10**38), two_s_complement(2**130), "", "?", 5):
        assert decoded(topic, [row(schema, {"d": bad})]) == ["not a bytes: d"], bad


def test_dates_and_times(topic):
    schema = struct(
        logical("day", "int32", "Date"), logical("at", "int32", "Time"), logical("ts", "int64", "Timestamp"),
        field("raw", "bytes", optional=True), logical("plain", "int64", "Date", optional=True),
    )
    found = decoded(topic, [
        row(schema, {"day": 0, "at": 0, "ts": 0, "raw": "AAH/", "plain": 7}),
        row(schema, {"day": -1, "at": 86_399_999, "ts": -1}),
        row(schema, {"day": 20_000, "at": 86_400_000, "ts": 5}),
    ])
    first = datetime.datetime(1970, 1, 1)
    assert found[0] == {"day": datetime.date(1970, 1, 1), "at": 0, "ts": first, "raw": b"\0\1\xff", "plain": 7}
    assert found[1]["day"] == datetime.date(1969, 12, 31) and found[1]["ts"] == first - datetime.timedelta(milliseconds=1)
    assert found[2] == "not an int32: at"
    types = Node.of(schema).type
    assert [f.dataType for f in types] == [
        T.DateType(), T.IntegerType(), T.TimestampType(), T.BinaryType(), T.LongType()
    ]


def test_a_frame_without_rows_or_schemas(topic):
    assert decoded(topic, [None, "x"])[1] == "payload is not an object"
    assert decode_declared(topic(["{}"]).limit(0)).count() == 0
