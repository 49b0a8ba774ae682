import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from topicflow.operators.evolve import SchemaConflict, align_to, merge_schemas, union_evolving


def ddl(text):
    return T.StructType.fromDDL(text)


def test_current_fields_first_new_fields_appended(spark):
    merged = merge_schemas(
        ddl("a int, s struct<x: int, y: string>, l array<struct<p: int>>, m map<string, struct<q: int>>"),
        ddl("z double, s struct<w: int, x: int>, l array<struct<o: int, p: int>>, m map<string, struct<r: int>>, a int"),
    )
    assert merged.simpleString() == (
        "struct<a:int,s:struct<x:int,y:string,w:int>,l:array<struct<p:int,o:int>>,"
        "m:map<string,struct<q:int,r:int>>,z:double>"
    )


@pytest.mark.parametrize(
    "a, b",
    [
        ("a int", "a bigint"),
        ("a bigint", "a double"),
        ("a string", "a struct<x: int>"),
        ("a array<int>", "a array<string>"),
        ("a map<string, int>", "a map<int, int>"),
        ("a decimal(9,5)", "a decimal(9,4)"),
        ("a struct<b: struct<c: int>>", "a struct<b: struct<c: string>>"),
        ("a int", "a date"),
    ],
)
def test_conflicts(spark, a, b):
    with pytest.raises(SchemaConflict) as e:
        merge_schemas(ddl(a), ddl(b))
    assert e.value.field.startswith("a") and "previous" in str(e.value)


def test_optional_if_either_is_and_metadata_survives():
    a = T.StructType([T.StructField("a", T.LongType(), False, {"doc": "x"}), T.StructField("b", T.LongType(), False)])
    b = T.StructType([T.StructField("a", T.LongType(), False, {"unit": "m"})])
    merged = merge_schemas(a, b)
    assert merged["a"].nullable is False and merged["a"].metadata == {"doc": "x", "unit": "m"}
    assert merged["b"].nullable is True


primitive = st.sampled_from([T.LongType(), T.StringType(), T.DoubleType()])
schema = st.recursive(
    primitive,
    lambda t: st.one_of(
        st.dictionaries(st.sampled_from("abcd"), t, min_size=1, max_size=3).map(
            lambda d: T.StructType([T.StructField(n, x) for n, x in d.items()])
        ),
        t.map(T.ArrayType),
    ),
    max_leaves=6,
)
struct = st.dictionaries(st.sampled_from("abcd"), schema, min_size=1, max_size=4).map(
    lambda d: T.StructType([T.StructField(n, x) for n, x in d.items()])
)


@given(struct, struct)
def test_merge_is_idempotent_and_keeps_order(a, b):
    assert merge_schemas(a, a) == a
    try:
        merged = merge_schemas(a, b)
    except SchemaConflict:
        with pytest.raises(SchemaConflict):
            merge_schemas(b, a)
        return
    assert merge_schemas(merged, b) == merged and merge_schemas(merged, a) == merged
    assert merged.names[: len(a.names)] == a.names
    assert set(merged.names) == set(a.names) | set(b.names)


def test_align_everywhere(spark):
    df = spark.sql(
        """select named_struct('x', 1) as s, array(named_struct('p', 1), null) as l,
           map('k', named_struct('q', 1)) as m, map(named_struct('k', 1), 'v') as mk, 7 as a"""
    )
    target = ddl(
        "a int, more string, m map<string, struct<q: int, r: int>>, mk map<struct<k: int, j: int>, string>, "
        "l array<struct<o: int, p: int>>, s struct<w: string, x: int>"
    )
    out = align_to(df, target)
    assert out.schema.simpleString() == target.simpleString()
    row = out.first()
    assert tuple(row["s"]) == (None, 1) and tuple(row["l"][0]) == (None, 1) and row["l"][1] is None
    assert tuple(row["m"]["k"]) == (1, None) and list(row["mk"].values()) == ["v"]
    assert row["more"] is None and row["a"] == 7
    with pytest.raises(ValueError):
        align_to(df, ddl("a int"))


def test_null_struct_stays_null(spark):
    df = spark.sql("select cast(null as struct<x: int>) as s")
    assert align_to(df, ddl("s struct<x: int, y: int>")).first()["s"] is None


def test_union_is_strict(spark):
    a, b = spark.sql("select 1L as n, 'x' as t"), spark.sql("select 'y' as t, true as f")
    rows = {tuple(r) for r in union_evolving(a, b).collect()}
    assert rows == {(1, "x", None), (None, "y", True)}
    with pytest.raises(SchemaConflict):
        union_evolving(a, spark.sql("select 'one' as n"))
