import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.decode import (
    compact_json,
    decode_json,
    decode_xml,
    drop_tombstones,
    require_object,
)
from topicflow.operators.declared import decode_declared
from topicflow.operators.evolve import SchemaConflict
from topicflow.operators.infer import field_types, fields_of, infer_schema, row_shapes, schema_conflicts, shape_fields
from topicflow.operators.validate import check_key_names, split_invalid, validate_keys


def decoded(df, **options):
    rows = decode_json(df, **options).orderBy("offset").collect()
    return [(r["value"].asDict(True) if r["value"] else None, list(r["_invalid"])) for r in rows]


def test_schemaless_types(topic):
    payload = {
        "aLong": 12, "empty": "", "aDouble": 1.5, "whole": 1.0, "o": {"p": {"q": "x"}}, "yes": True,
        "ports": ["Oslo", "Genoa"], "nums": [7, 9], "gone": None, "map": {}, "huge": 2**70,
    }
    df = topic([json.dumps(payload)])
    schema = infer_schema(df)
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "aLong": "bigint", "empty": "string", "aDouble": "double", "whole": "double",
        "o": "struct<p:struct<q:string>>", "yes": "boolean", "ports": "string", "nums": "string",
        "map": "string", "huge": "double",
    }
    ((row, bad),) = decoded(df)
    assert bad == [] and row["ports"] == '["Oslo","Genoa"]' and row["nums"] == "[7,9]"
    assert row["o"] == {"p": {"q": "x"}} and row["empty"] == "" and row["map"] == "{}"
    assert "gone" not in row


def test_mixed_list_is_json_text(topic):
    ((row, _),) = decoded(topic(['{"readings": [ false, "dry", 20 ]}']))
    assert row == {"readings": '[false,"dry",20]'}


def test_collections_can_be_discarded(topic):
    assert infer_schema(topic(['{"a":[1],"b":{"c":[2],"d":1}}']), discard_collections=True).simpleString() == (
        "struct<b:struct<d:bigint>>"
    )


@pytest.mark.parametrize("text", ["[1,2]", '"text"', "12", "null", "true", "{bad", "{}", " { } "])
def test_payloads_that_are_no_record(topic, text):
    rows = decoded(topic([text, '{"a":1}']))
    assert rows[0][0] is None and len(rows[0][1]) == 1 and rows[1] == ({"a": 1}, [])
    flagged = require_object(topic([text, '{"a":1}'])).orderBy("offset").collect()
    assert len(flagged[0]["_invalid"]) == 1 and flagged[1]["_invalid"] == []


def test_empty_keys_at_any_depth(topic):
    rows = decoded(
        topic(['{"a":1,"":2}', '{"b":{"":{"x":1}}}', '{"":null,"a":3}', '{"l":[{"":1}]}', '{"a":4}'])
    )
    assert [bad for _, bad in rows] == [["empty key"], ["empty key"], [], [], []]
    assert rows[2][0]["a"] == 3 and rows[3][0]["l"] == '[{"":1}]'


def test_repeated_key_keeps_last(topic):
    df = topic(['{"a":1,"a":2}', '{"a":true,"a":"x"}'])
    assert decoded(df.filter("offset = 0")) == [({"a": 2}, [])]
    assert {(r["type"], r["rows"]) for r in field_types(df).collect()} == {("bigint", 1), ("string", 1)}
    assert schema_conflicts(df).count() == 2


def test_empty_keys_under_a_declared_schema(topic):
    df = topic(['{"":1,"a":2}', '{"a":1,"o":{"":[1],"b":2}}', '{"a":3,"o":{"b":2}}', '{"":null,"a":4}', '{"":5}'])
    schema = T.StructType.fromDDL("a bigint, o struct<b: bigint>")
    rows = decoded(df, schema=schema)
    assert [bad for _, bad in rows] == [["empty key"], ["empty key"], [], [], ["empty key"]]
    assert rows[2][0] == {"a": 3, "o": {"b": 2}} and rows[3][0] == {"a": 4, "o": None}


def test_a_truncated_object_is_called_malformed(topic):
    rows = require_object(topic(['{"a":1', "[1", '{"a":1}'])).orderBy("offset").collect()
    assert [list(r["_invalid"]) for r in rows] == [["malformed payload"], ["payload is not an object"], []]


def test_declared_schema_flags_other_types(topic):
    df = topic(['{"a":1,"b":{"c":[1,2]}}', '{"a":"x"}', '{"b":{}}'])
    rows = decoded(df, schema=T.StructType.fromDDL("a int, b struct<c: array<int>>"))
    assert rows[0] == ({"a": 1, "b": {"c": [1, 2]}}, [])
    assert rows[1][1] == ["payload does not match the schema"]
    assert rows[2][0]["a"] is None


def test_flags_do_not_depend_on_selected_columns(topic):
    df = decode_json(topic(['{"a":"x","b":1}']), T.StructType.fromDDL("a int, b int"))
    assert df.select("value.b", "_invalid").first()["_invalid"] == ["payload does not match the schema"]


def test_payload_is_parsed_once(topic):
    df = decode_json(topic(['{"a":1}']), T.StructType.fromDDL("a int"))
    valid, _ = split_invalid(df)
    plan = valid.select("value.a")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_long_against_double_conflicts_unless_widened(topic):
    df = topic(['{"a":1}', '{"a":1.5}'])
    with pytest.raises(SchemaConflict) as e:
        decode_json(df)
    assert (e.value.field, e.value.previous, e.value.current) == ("a", "bigint", "double")
    assert infer_schema(df, widen_numbers=True).simpleString() == "struct<a:double>"
    assert infer_schema(topic(['{"a":[1]}', '{"a":"x"}'])).simpleString() == "struct<a:string>"


def test_field_order_is_first_appearance(topic):
    assert infer_schema(topic(['{"z":1}', '{"b":1,"z":1}', '{"a":1}'])).names == ["z", "b", "a"]


def test_shape_reader():
    shape = "OBJECT<``: BIGINT, `a b`: OBJECT<`c``d>`: STRING, e: VOID>, f: ARRAY<OBJECT<`x>`: BIGINT>>, g: OBJECT<>, h: DECIMAL>"
    assert shape_fields(shape) == [
        ([""], "bigint"), (["a b"], "struct"), (["a b", "c`d>"], "string"), (["f"], "list"),
        (["g"], "empty"), (["h"], "double"),
    ]


def test_fields_of_several_shapes(topic):
    df = topic(['{"a":1}', '{"b":"x"}', '{"a":2,"c":{"d":true}}'])
    assert infer_schema(df).simpleString() == "struct<a:bigint,b:string,c:struct<d:boolean>>"
    found = {(tuple(r["path"]), r["type"], r["first"], r["rows"]) for r in field_types(df).collect()}
    assert found == {
        (("a",), "bigint", 0, 2), (("b",), "string", 1, 1), (("c",), "struct", 2, 1), (("c", "d"), "boolean", 2, 1)
    }
    assert fields_of(row_shapes(df)).count() == 4


def test_conflict_report(topic):
    rows = schema_conflicts(topic(['{"a":1,"b":1}', '{"a":"x","b":2}', '{"a":2}', '{"a":{"q":1}}'])).collect()
    assert {tuple(r) for r in rows} == {("a", "bigint", 0, 2), ("a", "string", 1, 1), ("a", "struct", 3, 1)}


def test_tombstones(topic):
    assert drop_tombstones(topic(["{}", None, "x"])).count() == 2


def test_envelope_with_schema(topic):
    schema = {
        "type": "struct",
        "fields": [
            {"field": "i", "type": "int32"}, {"field": "s", "type": "string", "optional": True},
            {"field": "n", "type": "struct", "fields": [{"field": "l", "type": "array", "items": {"type": "int64"}}]},
            {"field": "m", "type": "map", "keys": {"type": "string"}, "values": {"type": "double"}},
        ],
    }
    wider = {"type": "struct", "fields": [{"field": "i", "type": "int32"}, {"field": "more", "type": "boolean"}]}
    rows = decode_declared(
        topic([
            json.dumps({"schema": schema, "payload": {"i": 1, "s": "x", "n": {"l": [1, 2]}, "m": {"k": 1.5}}}),
            json.dumps({"schema": wider, "payload": {"i": 2, "more": True}}),
            json.dumps({"schema": wider, "payload": None}),
        ])
    )
    assert {f.name for f in rows.schema["value"].dataType} == {"i", "s", "n", "m", "more"}
    first, second, third = rows.orderBy("offset").collect()
    assert first["value"]["n"]["l"] == [1, 2] and first["value"]["m"] == {"k": 1.5}
    assert second["value"]["more"] is True and third["_invalid"] == ["payload is not an object"]


WEATHER = """
<w:diary xmlns:w="urn:weather" kind="wind" unit="kn" w:station="4">
 <gust>12</gust>
 <hours><h>0</h><mean>7</mean><h>6</h><mean>9</mean><h>12</h></hours>
 <gust>31</gust>
 <sea state="3" swell="2" dir="NW"><w:calm/></sea>
 <gust>18</gust>
</w:diary>"""


def test_xml(topic):
    """Repeats form lists wherever they stand, at any depth; attributes are fields, prefixes go."""
    first, second = decode_xml(topic([WEATHER, "<d unit='m/s'><gust>40</gust></d>"])).orderBy("offset").collect()
    diary = first["value"]
    assert (diary["kind"], diary["unit"], diary["station"]) == ("wind", "kn", "4")
    assert json.loads(diary["gust"]) == ["12", "31", "18"]
    assert [json.loads(diary["hours"][n]) for n in ("h", "mean")] == [["0", "6", "12"], ["7", "9"]]
    assert diary["sea"].asDict() == {"state": "3", "swell": "2", "dir": "NW", "calm": ""}
    assert (second["value"]["gust"], second["value"]["unit"], second["value"]["sea"]) == ("40", "m/s", None)


def test_xml_that_is_no_record(topic):
    texts = ["<v><cargo>tin</v>", "plain", "<r>text</r>", "<r/>", '<r><a k="1">text</a></r>', "<r><a>1</a></r>"]
    rows = decode_xml(topic(texts), mixed=True).orderBy("offset").collect()
    assert [r["_invalid"] for r in rows] == [
        ["malformed XML"], ["malformed XML"], ["payload is not an object"], ["payload is not an object"],
        ["empty key"], [],
    ]


def test_compact_json_keeps_key_order(topic):
    df = topic(['{ "b" : 1.50, "a" : [1, {"z": null}] }']).select(compact_json(F.col("value")).alias("v"))
    assert df.first()["v"] == '{"b":1.5,"a":[1,{"z":null}]}'


def test_key_checks(topic):
    df = decode_json(topic(['{"k":1,"j":1}', '{"j":2}', '{"k":null}', '{"k":3}']))
    reasons = [list(r["_invalid"]) for r in validate_keys(df, ["k", "j"], column="value").orderBy("offset").collect()]
    assert reasons == [[], ["null key: k"], ["null key: k,j"], ["null key: j"]]
    allowed = validate_keys(df, ["k"], allow_null=True, column="value")
    assert allowed.filter(F.size("_invalid") > 0).count() == 0
    missing = validate_keys(df, ["q", "r"], allow_null=True, column="value").first()
    assert missing["_invalid"] == ["missing key: q,r"]
    for bad in ("1a", "a-b", "a b", ""):
        with pytest.raises(ValueError):
            check_key_names([bad])
    check_key_names(["_a1", "a_B"])


def test_invalid_rows_fail_the_job_unless_told_to_go_on(topic):
    df = decode_json(topic(['{"a":1}', "[1]", '{"a":2}']))
    valid, dead = split_invalid(df)
    assert valid.count() == 2 and [r["reason"] for r in dead.collect()] == ["payload is not an object"]
    strict, _ = split_invalid(df, continue_on_invalid=False)
    with pytest.raises(Exception, match="invalid row: payload is not an object"):
        strict.collect()


def test_object_beside_plain_value(topic):
    from topicflow.operators.flatten import flatten

    texts = ['{"a":5}', '{"a":{"b":"x","c":{"d":1}}}', '{"a":{}}', '{"a":null,"z":1}', '{"a":{"b":"y","":1}}']
    with pytest.raises(SchemaConflict):
        decode_json(topic(texts))
    texts[2] = '{"a":7}'
    df = flatten(decode_json(topic(texts), mixed=True), "value").orderBy("offset")
    rows = [(r["value"].asDict(), list(r["_invalid"])) for r in df.collect()]
    assert rows[0] == ({"a": 5, "a_b": None, "a_c_d": None, "z": None}, [])
    assert rows[1] == ({"a": None, "a_b": "x", "a_c_d": 1, "z": None}, [])
    assert rows[2][0]["a"] == 7 and rows[3][0]["z"] == 1 and rows[4][1] == ["empty key"]
    empty = flatten(decode_json(topic(['{"a":{}}', '{"a":{"b":1}}']), mixed=True), "value").orderBy("offset")
    assert [tuple(r["value"]) for r in empty.collect()] == [("{}", None), (None, 1)]
