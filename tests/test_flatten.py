import json
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.convert import decimals_to_double, lowercase_fields
from topicflow.operators.explode import explode_container, explode_schema
from topicflow.operators.flatten import chunk_json, flat_name, flatten, leaves
from topicflow.operators.metadata import embed_metadata, order_column_for


def test_flatten_nested_user(spark):
    df = spark.createDataFrame(
        [("bobo", "mr", 100.0, ("Unter", 12)), ("ann", None, None, None)],
        "name string, title string, salary double, street struct<name: string, number: int>",
    )
    flat = flatten(df)
    assert flat.columns == ["name", "title", "salary", "street_name", "street_number"]
    assert [tuple(r) for r in flat.collect()] == [
        ("bobo", "mr", 100.0, "Unter", 12), ("ann", None, None, None, None)
    ]
    assert all(f.nullable for f in flat.schema)


def test_names_are_sanitised_and_collisions_raise(spark):
    df = spark.sql("select named_struct('a nested!field', 'x', 'a?nested string', 'y') as `a#struct`")
    assert flatten(df).columns == ["a_struct_a_nested_field", "a_struct_a_nested_string"]
    with pytest.raises(ValueError, match="become column"):
        flatten(spark.sql("select 1 as a_b, named_struct('b', 2) as a"))
    with pytest.raises(ValueError):
        flatten(spark.sql("select 1 as `x y`, 2 as `X?y`"))


def test_collections_become_json(spark):
    df = spark.sql(
        """select named_struct('l', array(1, null), 'm', map('k', named_struct('x', cast(null as int))),
           'e', cast(array() as array<int>), 'n', cast(null as array<int>), 'i', map(1, 'a', 2, null)) as s"""
    )
    row = flatten(df).first()
    assert row["s_l"] == "[1,null]" and row["s_m"] == '{"k":{"x":null}}' and row["s_e"] == "[]"
    assert row["s_n"] is None and row["s_i"] == '[[1,"a"],[2,null]]'
    assert flatten(df, discard_collections=True).columns == []


def test_flatten_adds_no_shuffle_and_prunes(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.sql("select named_struct('a', 1, 'b', named_struct('c', 2, 'd', 'x')) as s").write.parquet(path)
    plan = flatten(spark.read.parquet(path)).select("s_b_c")._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<s:struct<b:struct<c:int>>>" in plan


def test_chunks_of_nested_lists(spark):
    df = spark.sql("""select '{"k":[[],{"é":-1}]}' as value""")
    assert list(chunk_json(df, 4, 7, "value").first()["value"]) == ['{"k":[[', '],{"é"', ":-1}]}", None]


def test_chunk_limits(spark):
    def cut(text, chunks, length):
        df = spark.createDataFrame([(text,)], "value string")
        return list(chunk_json(df, chunks, length, "value").first()["value"])

    assert cut("0123456789", 5, 2) == ["01", "23", "45", "67", "89"]
    assert cut("012", 5, 2) == ["01", "2", None, None, None]
    with pytest.raises(Exception, match="5 chunks of 2 bytes cannot hold a record of 11 bytes"):
        cut("0123456789a", 5, 2)
    assert cut("hé", 2, 2) == ["h�", "�"]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(st.characters(min_codepoint=32, max_codepoint=126), min_size=1, max_size=60), st.integers(1, 9))
def test_chunks_of_ascii_put_together_give_the_text(spark, text, length):
    df = spark.createDataFrame([(text,)], "value string")
    pieces = chunk_json(df, 60, length, "value").first()["value"]
    assert "".join(p for p in pieces if p is not None) == text


def test_record_chunks_keep_nulls(spark):
    df = spark.sql("select 1 as k, 'x' as a, cast(null as int) as b")
    row = chunk_json(df, 1, 100, keep=["k"]).first()
    assert json.loads(row["payload_chunk1"]) == {"a": "x", "b": None} and row["k"] == 1


def test_decimals_to_double_at_any_depth(spark):
    df = spark.sql(
        """select named_struct('price', 7.25BD, 'weight', 2.5F) as item, 0.5BD as d,
           cast(null as decimal(9,5)) as none, array(1.5BD) as l, map('k', 2.5BD) as m, 1 as i"""
    )
    out = decimals_to_double(df)
    assert "decimal(" not in out.schema.simpleString()
    row = out.first()
    assert row["item"]["price"] == 7.25 and row["d"] == 0.5 and row["none"] is None
    assert row["l"] == [1.5] and row["m"] == {"k": 2.5} and row["i"] == 1


def test_lowercase_fields(spark):
    df = spark.sql("select named_struct('Inner', 'abc') as nEsted, 'def' as STRING, map('Key', 1) as M")
    out = lowercase_fields(df)
    assert out.columns == ["nested", "string", "m"]
    row = out.first()
    assert row["nested"]["inner"] == "abc" and row["m"] == {"Key": 1}
    with pytest.raises(ValueError):
        lowercase_fields(spark.sql("select named_struct('A', 1, 'a', 2) as s"))


def test_metadata_columns(topic):
    df = topic(['{"a":1}'], partition=1, first=101)
    row = embed_metadata(df, order_column="__order").first()
    assert (row["kafkaPartition"], row["kafkaOffset"], row["kafkaTimestamp"]) == (1, 101, 101000)
    assert row["kafkaPartitionOffset"] == "1_101" and row["__order"] == 101
    only_order = embed_metadata(df, lineage=False, order_column="o")
    assert only_order.columns == [*df.columns, "o"]
    assert embed_metadata(df, lineage=False).columns == df.columns
    null_time = df.withColumn("timestamp", F.lit(None).cast("timestamp"))
    assert embed_metadata(null_time).first()["kafkaTimestamp"] is None
    assert order_column_for([]) is None and order_column_for(["a"]) == "__order"
    assert order_column_for(["a"], "v") == "v" and order_column_for([], "v") is None


def test_explode_container(spark):
    df = spark.createDataFrame(
        [([("a", 1, 10), ("b", 2, 20)],), ([],), (None,)],
        "messages array<struct<id: string, int_field: int, long_field: bigint>>",
    )
    out = explode_container(df)
    assert [tuple(r) for r in out.collect()] == [("a", 1, 10), ("b", 2, 20)]
    assert explode_schema(df.schema).names == ["id", "int_field", "long_field"]
    assert explode_container(df, outer=True).count() == 4
    two = df.withColumn("more", F.lit(1))
    assert explode_container(two).columns == two.columns
    texts = spark.sql("select array('a', 'b') as messages")
    assert explode_container(texts).count() == 1


def test_type_matrix_survives_parquet(spark, tmp_path):
    path = str(tmp_path / "types")
    spark.sql(
        """select cast(1 as tinyint) a, cast(2 as smallint) b, 3 c, 4L d, 5F e, 6D f, true g, 'x' h, X'01' i,
           date'2020-01-02' j, timestamp'2020-01-02 03:04:05.678' k, cast(1.5 as decimal(9,5)) l"""
    ).write.parquet(path)
    back = flatten(spark.read.parquet(path))
    kinds = "byte short int bigint float double boolean string binary date timestamp decimal(9,5)".split()
    assert [f.dataType.simpleString().replace("tinyint", "byte").replace("smallint", "short") for f in back.schema] == kinds
    assert back.first()["j"] == date(2020, 1, 2)


names = st.text("ab", min_size=1, max_size=2)
types = st.recursive(
    st.sampled_from([T.LongType(), T.StringType(), T.DoubleType()]),
    lambda inner: st.dictionaries(names, inner, min_size=1, max_size=3).map(
        lambda d: T.StructType([T.StructField(n, t) for n, t in d.items()])
    ),
    max_leaves=8,
)


@given(st.dictionaries(names, types, min_size=1, max_size=3))
def test_leaves_cover_every_primitive(fields):
    schema = T.StructType([T.StructField(n, t) for n, t in fields.items()])
    found = list(leaves(schema))

    def count(t):
        return sum(count(f.dataType) for f in t) if isinstance(t, T.StructType) else 1

    assert len(found) == count(schema) == len({p for p, _ in found})
    assert all(flat_name(p).replace("_", "").isalnum() for p, _ in found)
