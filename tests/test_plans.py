import glob
import json
import os
import random
import re
import time

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.evolve import SchemaConflict
from topicflow.operators.latest import column_ddl, latest_per_key, merge_latest, overlong_strings
from topicflow.operators.mask import Mask
from topicflow.operators.segment import segment
from topicflow.plans import ingest, log
from topicflow.plans.ingest import Store, ingest_batch
from topicflow.plans.options import Options
from topicflow.plans.transform import explode_rows, transform
from topicflow.session import checkpoint_folder
from topicflow.sinks.parquet import create_target_sql, read_table, row_group_bytes_for, upsert_table, write_segments
from topicflow.sources.topic import TOPIC_SCHEMA, as_topic, read_topic
from topicflow.streaming.ingest import ingest_stream
from topicflow.streaming.segments import closed_segments, idle_sessions, segment_closer, track_segments


@pytest.mark.parametrize(
    "bad",
    [
        dict(table=" "), dict(format="csv"), dict(keys="1a"), dict(keys=("a-b",)),
        dict(flatten=False, discard_collections=True),
        dict(flatten=False, json_chunks=2, varchar_length=10), dict(json_chunks=2),
        dict(json_chunks=0, varchar_length=5), dict(varchar_length=0), dict(varchar_length=65001),
        dict(max_bytes=99_999), dict(max_records=0), dict(idle=1000), dict(row_group_bytes=0),
    ],
)
def test_options_are_checked(bad):
    with pytest.raises(ValueError):
        Options(**bad)


def test_option_values():
    o = Options(keys=" a, b ,", varchar_length=65000, max_bytes=100_000, idle=1001, max_records=1)
    assert o.keys == ("a", "b") and o.order_column == "__order" == o.embedded_order
    assert Options(keys="a", order_by="v").embedded_order is None and Options().order_column is None
    assert row_group_bytes_for(500, 100) == 100 and row_group_bytes_for(None, 1) is None


def values(df):
    return [r["value"].asDict(True) for r in df.orderBy("offset").collect()]


PLAIN = dict(embed_metadata=False, continue_on_invalid=True)


def test_transform_evolves_and_aligns(topic):
    first = transform(topic(['{"port":"Oslo","berth":1,"draught":1.5}']), Options(**PLAIN))
    second = transform(topic(['{"port":"Hull","empty":true}']), Options(**PLAIN), first.schema)
    assert values(second.valid) == [{"port": "Hull", "berth": None, "draught": None, "empty": True}]
    with pytest.raises(SchemaConflict):
        transform(topic(['{"port":1}']), Options(**PLAIN), first.schema)


def by_bytes(text, chunks, width):
    raw = text.encode()
    parts = [raw[i * width : (i + 1) * width].decode("utf-8", "replace") or None for i in range(chunks)]
    return {f"payload_chunk{i}": p for i, p in enumerate(parts, 1)}


def test_transform_chunks_payloads_with_any_keys(topic):
    o = Options(json_chunks=3, varchar_length=17, **PLAIN)
    texts = ['{ "depths" : [3.5, "é", null, [true]], "at": "q"}', '{"a b":{"":[]},"-":1}']
    compact = ['{"depths":[3.5,"é",null,[true]],"at":"q"}', texts[1]]
    found = values(transform(topic(texts), o).valid)
    assert found == [by_bytes(t, 3, 17) for t in compact] and found[0]["payload_chunk1"].endswith("\ufffd")
    xml = Options(format="xml", json_chunks=1, varchar_length=60, **PLAIN)
    (row,) = values(transform(topic(["<r><k v='2'/><k>é</k></r>"]), xml).valid)
    assert row == {"payload_chunk1": '{"k":[{"v":"2"},"é"]}'}


def test_masks_and_keys_see_flat_names_and_lineage(topic):
    o = Options(keys="kafkaOffset,user_id", mask=Mask("user_name, kafkaPartitionOffset, user.name"), continue_on_invalid=True)
    out = transform(topic(['{"user":{"id":1,"name":"x"}}', '{"user":{"name":"y"}}', "[1]", None]), o)
    (row,) = values(out.valid)
    assert row["user_name"] == "*****" == row["kafkaPartitionOffset"] and row["user_id"] == 1 and row["__order"] == 0
    dead = {r["offset"]: (r["value"], r["reason"]) for r in out.dead_letters.collect()}
    assert dead == {
        1: ('{"user":{"name":"y"}}', "null key: user_id"), 2: ("[1]", "payload is not an object"),
    }


def test_declared_rows_are_converted_first(spark, topic):
    schema = T.StructType.fromDDL("Amount decimal(9,5), Inner struct<Name: string>")
    o = Options(schema=schema, decimals_to_double=True, lowercase=True, **PLAIN)
    assert values(transform(topic(['{"Amount":0.12345,"Inner":{"Name":"x"}}']), o).valid) == [
        {"amount": 0.12345, "inner_name": "x"}
    ]
    nested = Options(schema=schema, flatten=False, **PLAIN)
    assert values(transform(topic(['{"Inner":{"Name":"x"}}']), nested).valid)[0]["Inner"] == {"Name": "x"}


def test_struct_records(spark):
    df = spark.sql(
        """select 't' topic, 0 partition, 1L offset, timestamp_seconds(1) timestamp,
           named_struct('a', 1, 'b', array(1, 2)) value"""
    )
    assert values(transform(df, Options(format="struct", **PLAIN)).valid) == [{"a": 1, "b": "[1,2]"}]


def test_containers_explode_after_segmentation(topic, tmp_path):
    schema = T.StructType.fromDDL("messages array<struct<id: string, more: struct<n: int>>>")
    text = '{"messages":[{"id":"a","more":{"n":1}},{"id":"b"}]}'
    o = Options(schema=schema, explode=True, continue_on_invalid=True, max_records=2)
    rows = explode_rows(transform(topic([text]), o).valid, o)
    assert [(r["value"]["id"], r["value"]["more_n"], r["value"]["kafkaOffset"]) for r in rows.collect()] == [
        ("a", 1, 0), ("b", None, 0)
    ]
    store = ingest_batch(rows.sparkSession, topic([text] * 5), str(tmp_path), o)
    assert store.rows().count() == 8
    assert sorted(r["rows"] for r in store.manifest(o).collect()) == [2, 2]


def payloads(n, first=0):
    return [json.dumps({"k": i % 3, "v": i}) for i in range(first, first + n)]


def test_batches_publish_closed_segments_once(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(keys="k", max_records=4, continue_on_invalid=True)
    store = ingest_batch(spark, topic(payloads(10)), path, o)
    assert sorted(r["v"] for r in store.rows().collect()) == list(range(8))
    assert [tuple(r) for r in store.committed(o).collect()] == [("t", 0, 7)]
    ingest_batch(spark, topic(payloads(13)), path, o)
    assert sorted(r["v"] for r in store.rows().collect()) == list(range(12))
    ingest_batch(spark, topic(payloads(13)), path, o, flush=True)
    assert sorted(r["v"] for r in store.rows().collect()) == list(range(13))
    manifest = store.manifest(o).orderBy("segment").collect()
    assert [(r["segment"], r["rows"], r["closed"]) for r in manifest] == [(0, 4, True), (1, 4, True), (2, 4, True), (3, 1, True)]
    latest = latest_per_key(store.rows(), ["k"], "__order").collect()
    assert {(r["k"], r["v"]) for r in latest} == {(0, 12), (1, 10), (2, 11)}


def test_failed_publish_is_repeated_without_duplicates(spark, topic, tmp_path, monkeypatch):
    path, o = str(tmp_path), Options(max_records=4, continue_on_invalid=True)

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(ingest, "commit", fail)
        with pytest.raises(OSError):
            ingest_batch(spark, topic(payloads(9)), path, o)
    assert Store(spark, path).manifest(o) is None
    store = ingest_batch(spark, topic(payloads(9) + ["[1]"]), path, o)
    assert sorted(r["v"] for r in store.rows().collect()) == list(range(8))
    dead = spark.read.parquet(f"{path}/dead_letters/batch=0").collect()
    assert [(r["offset"], r["value"], r["reason"]) for r in dead] == [(9, "[1]", "payload is not an object")]


def test_schema_grows_across_batches(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(embed_metadata=False)
    ingest_batch(spark, topic(['{"a":1}']), path, o)
    store = ingest_batch(spark, topic(['{"a":1}', '{"b":{"c":"x"},"segment":5,"topic":"own"}']), path, o)
    rows = {tuple(r) for r in store.rows().select("a", "b_c", "segment", "topic").collect()}
    assert rows == {(1, None, None, None), (None, "x", 5, "own")}


def test_type_change_starts_another_version(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(max_records=3, embed_metadata=False, continue_on_invalid=True)
    texts = ['{"a":1}', '{"a":2,"b":true}', '{"a":"x"}', '{"a":"y"}', '{"a":3}', "[1]", '{"a":4}']
    ingest.publish(topic(texts), 0, path, o)
    ingest.publish(topic(['{"a":5}', '{"a":"z"}'], first=7), 1, path, o)
    store = Store(spark, path)
    with pytest.raises(ValueError, match="2 schemas"):
        store.rows()
    assert [s["a"].dataType.simpleString() for s in store.schemas()] == ["bigint", "string"]
    found = {}
    for version in (0, 1):
        for r in store.rows(True, version).collect():
            found[r["__offset"]] = (r["a"], r["__segment"], r["__topic"])
    expected = [(1, 0), (2, 0), ("x", 1), ("y", 1), (3, 2), None, (4, 2), (5, 2), ("z", 3)]
    assert found == {i: (*e, "t") for i, e in enumerate(expected) if e}
    dead = spark.read.parquet(f"{path}/dead_letters/batch=0").collect()
    assert [(r["offset"], r["value"]) for r in dead] == [(5, "[1]")]
    assert {(r["segment"], r["rows"], r["closed"]) for r in store.manifest(o).collect()} == {
        (0, 2, True), (1, 2, True), (2, 3, True), (3, 1, False)
    }


def test_repeated_keys_of_another_type_do_not_stop_a_batch(spark, topic, tmp_path):
    o = Options(embed_metadata=False)
    store = ingest_batch(spark, topic(['{"k":1}', '{"k":"x","k":"y"}', '{"k":2}']), str(tmp_path), o)
    found = {r["__offset"]: r["k"] for n in (0, 1) for r in store.rows(True, n).collect()}
    assert found == {0: 1, 1: "y", 2: 2}


def test_batch_without_any_record(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(max_records=3, embed_metadata=False, continue_on_invalid=True)
    ingest.publish(topic(["[1]", "{}"]), 0, path, o)
    ingest.publish(topic(['{"a":1}'], first=2), 1, path, o)
    assert [r["a"] for r in Store(spark, path).rows().collect()] == [1]
    assert spark.read.parquet(f"{path}/dead_letters/batch=0").count() == 2


def test_stream_goes_on_where_it_stopped(spark, topic, tmp_path):
    source, path, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    o = Options(keys="k", max_records=4, idle="1h", continue_on_invalid=True)

    def arrive(n, first):
        topic(payloads(n, first), first=first).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = read_topic(spark, "parquet", {"maxFilesPerTrigger": "1"}, source, streaming=True)
        ingest_stream(stream, path, o, check).awaitTermination()

    arrive(6, 0)
    arrive(3, 6)
    run()
    arrive(4, 9)
    arrive(2, 11)  # offsets 11 and 12 come a second time
    run()
    store = Store(spark, path)
    got = store.rows(lineage=True).select("v", "__segment").collect()
    assert sorted(tuple(r) for r in got) == [(i, i // 4) for i in range(13)]
    manifest = {r["segment"]: (r["rows"], r["closed"]) for r in store.manifest(o).collect()}
    assert manifest == {0: (4, True), 1: (4, True), 2: (4, True), 3: (1, False)}
    later = store.manifest(o, F.timestamp_seconds(F.lit(12 + 3600))).collect()
    assert all(r["closed"] for r in later)
    assert store.committed(o).first()["offset"] == 11


def test_repeated_micro_batch_replaces_itself(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(max_records=4)
    ingest.publish(topic(payloads(5)), 0, path, o)
    ingest.publish(topic(payloads(3, 5), first=5), 1, path, o)
    ingest.publish(topic(payloads(3, 5), first=5), 1, path, o)
    rows = Store(spark, path).rows(lineage=True).select("v", "__segment").collect()
    assert sorted(tuple(r) for r in rows) == [(i, i // 4) for i in range(8)]


KEYED = dict(keys="k", order_by="at", embed_metadata=False, table="stock", buckets=4)


def stock(*rows):
    return [json.dumps(dict(zip(("k", "at", "v"), r))) for r in rows]


def contents(store, o, **more):
    return {(r["k"], r["at"], r["v"]) for r in store.latest(o, **more).collect()}


def test_keyed_batches_are_merged(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(**KEYED)
    store = Store(spark, path)
    ingest.publish(topic(stock(("a", 5, "x"), ("b", 1, "y"), ("a", 2, "late"))), 0, path, o)
    assert contents(store, o) == {("a", 5, "x"), ("b", 1, "y")}
    second = topic(stock(("a", 4, "lower"), ("b", 1, "equal"), ("c", 0, "z")), first=3)
    for _ in range(2):  # a batch that is run again changes nothing
        ingest.publish(second, 1, path, o)
        assert contents(store, o) == {("a", 5, "x"), ("b", 1, "equal"), ("c", 0, "z")}
    ingest.publish(topic(stock(("a", None, "no order"), ("d", 1, "w")), first=6), 2, path, o)
    assert contents(store, o) == {("a", 5, "x"), ("b", 1, "equal"), ("c", 0, "z"), ("d", 1, "w")}
    assert store.rows().count() == 8
    with pytest.raises(ValueError, match="comes before"):
        ingest.publish(second, 1, path, o)


def test_a_failed_merge_is_not_seen(spark, topic, tmp_path, monkeypatch):
    path, o = str(tmp_path), Options(**KEYED)
    ingest.publish(topic(stock(("a", 1, "x"))), 0, path, o)

    def fail(*_):
        raise OSError("no space")

    with monkeypatch.context() as m:
        m.setattr(ingest, "commit", fail)
        with pytest.raises(OSError):
            ingest.publish(topic(stock(("a", 9, "lost")), first=1), 1, path, o)
    assert contents(Store(spark, path), o) == {("a", 1, "x")}
    ingest.publish(topic(stock(("b", 2, "y")), first=1), 1, path, o)
    assert contents(Store(spark, path), o) == {("a", 1, "x"), ("b", 2, "y")}


def test_a_merge_rewrites_touched_buckets_only(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(**KEYED)
    ingest.publish(topic(stock(*[(f"k{i}", 1, "x") for i in range(40)])), 0, path, o)
    table = ingest.keyed_table(spark, path, o, 0)
    assert set(table.snapshot(0).places) == {0, 1, 2, 3}
    for batch in range(1, 7):
        ingest.publish(topic(stock(("k7", batch, "y")), first=39 + batch), batch, path, o)
        places = table.snapshot(batch).places
        assert sorted(places.values()) == [0, 0, 0, batch]
    assert len(contents(Store(spark, path), o)) == 40
    # superseded buckets are gone, but for those of the batches that are kept
    assert len(glob.glob(f"{path}/tables/stock/schema=0/data/batch=*/__bucket=*")) <= 3 + log.KEPT
    assert len(glob.glob(f"{path}/tables/stock/schema=0/snapshots/*.json")) == log.KEPT
    with pytest.raises(ValueError, match="4 buckets"):
        ingest.publish(topic(stock(("k7", 9, "y")), first=60), 7, path, Options(**{**KEYED, "buckets": 8}))


def test_keyed_tables_of_a_growing_and_of_a_changed_schema(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(**KEYED)
    ingest.publish(topic(stock(("a", 1, "x"), ("b", 1, "y"))), 0, path, o)
    ingest.publish(topic(['{"k":"a","at":2,"more":true}'], first=2), 1, path, o)
    store = Store(spark, path)
    rows = {(r["k"], r["at"], r["v"], r["more"]) for r in store.latest(o).collect()}
    assert rows == {("a", 2, None, True), ("b", 1, "y", None)}
    ingest.publish(topic(['{"k":"a","at":"2020","v":"z"}'], first=3), 2, path, o)
    assert contents(store, o, version=1) == {("a", "2020", "z")}
    assert {r["k"] for r in store.latest(o, version=0).collect()} == {"a", "b"}


def test_an_order_column_has_to_be_there(spark, topic, tmp_path):
    with pytest.raises(ValueError, match="no order column 'at'"):
        ingest_batch(spark, topic(['{"k":"a"}']), str(tmp_path), Options(**KEYED))
    store = Store(spark, str(tmp_path))
    assert store.parts() is None
    with pytest.raises(ValueError, match="nothing is published"):
        store.latest(Options(**KEYED))
    ingest_batch(spark, topic(['{"k":"a"}']), str(tmp_path), Options(embed_metadata=False))
    with pytest.raises(ValueError, match="no keyed table"):
        store.latest(Options(**KEYED))


def test_hot_and_null_keys(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(allow_null_keys=True, **KEYED)
    ingest.publish(topic(stock(*[("hot", i, str(i)) for i in range(300)], (None, 1, "n"), (None, 2, "m"))), 0, path, o)
    assert contents(Store(spark, path), o) == {("hot", 299, "299"), (None, 2, "m")}


def test_offsets_that_come_twice_are_published_once(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(embed_metadata=False, max_records=2, continue_on_invalid=True)
    rows = topic(payloads(7) + ["[1]"])
    ingest.publish(rows.unionAll(rows).unionAll(rows).repartition(5), 0, path, o)
    store = Store(spark, path)
    assert sorted(tuple(r) for r in store.rows(True).select("v", "__segment").collect()) == [(i, i // 2) for i in range(7)]
    assert {(r["segment"], r["rows"]) for r in store.parts().collect()} == {(0, 2), (1, 2), (2, 2), (3, 1)}
    assert spark.read.parquet(f"{path}/dead_letters/batch=0").count() == 1


def test_listing_stays_constant_and_nothing_staged_is_left(spark, topic, tmp_path, monkeypatch):
    monkeypatch.setattr(log, "COMPACT_AFTER", 4)
    path, o = str(tmp_path / "out"), Options(max_records=3, embed_metadata=False)
    checkpoint = checkpoint_folder(spark)
    before = set(os.listdir(checkpoint))
    for batch in range(11):
        ingest.publish(topic(payloads(2, 2 * batch), first=2 * batch), batch, path, o)
        assert len(glob.glob(f"{path}/commits/*")) <= log.KEPT
        # a base and deltas for each commit that is kept
        assert len(glob.glob(f"{path}/manifest/*")) <= 2 + log.COMPACT_AFTER + log.KEPT
        assert len(glob.glob(f"{path}/state/*")) <= log.KEPT
    assert set(os.listdir(checkpoint)) == before
    store = Store(spark, path)
    last = store.log.last()
    assert last.published == ((0, 10),) and last.base is not None and len(last.deltas) <= 4
    assert {(r["segment"], r["rows"]) for r in store.manifest(o).collect()} == {(i, 3) for i in range(7)} | {(7, 1)}
    assert sorted(r["v"] for r in store.rows().collect()) == list(range(22))


def exchanges_with(plan, column):
    """Exchanges in a formatted plan whose input still holds a column."""
    parts = re.split(r"\n\n+", plan)
    return sum(bool(re.match(r"\(\d+\) Exchange", p)) and f"{column}#" in p for p in parts)


def test_payloads_are_shuffled_once(spark, topic, tmp_path):
    rows = spark.read.schema("topic string, partition int, offset bigint, timestamp timestamp, value struct<v: string>, "
                             "__bytes bigint, __row bigint").parquet(str(tmp_path))  # fmt: skip
    o = Options(max_records=3)
    cut = ingest._cut([(rows, 0)], o, None, False)
    parts = cut.groupBy("topic", "partition", "segment").agg(F.lit(1))
    for frame, count in ((cut, 0), (ingest._placed(rows, cut, parts), 1)):
        plan = frame._sc._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")
        assert exchanges_with(plan, "value") == count


def test_topics_have_schemas_of_their_own(spark, topic, tmp_path):
    path, o = str(tmp_path), Options(embed_metadata=False, schema_per_topic=True, keys="id", order_by="at")
    both = topic(['{"id":1,"at":1}'], name="ships").unionAll(topic(['{"id":"a","at":1,"port":"x"}'], name="ports"))
    ingest.publish(both, 0, path, o)
    more = topic(['{"id":2,"at":1.5}'], name="ships", first=1).unionAll(topic(['{"id":"a","at":2}'], name="ports", first=1))
    ingest.publish(more, 1, path, o)
    store = Store(spark, path)
    assert (store.versions_of("ports"), store.versions_of("ships"), store.versions_of("x")) == ([0], [1, 2], [])
    assert {(r["id"], r["at"], r["port"]) for r in store.rows(version=0).collect()} == {("a", 1, "x"), ("a", 2, None)}
    assert [r["at"] for r in store.rows(version=1).collect()] == [1]
    assert [r["at"] for r in store.rows(version=2).collect()] == [1.5]
    assert [(r["id"], r["at"]) for r in store.latest(o, version=0).collect()] == [("a", 2)]
    ingest.publish(both.limit(0), 2, path, o)
    assert store.rows(version=0).count() == 2


def test_texts_wider_than_the_target_are_dead_letters(spark, topic, tmp_path):
    o = Options(varchar_length=3, embed_metadata=False, continue_on_invalid=True)
    store = ingest_batch(spark, topic(['{"a":"éé7","n":12345}', '{"a":"long","n":1}', '{"a":null}']), str(tmp_path), o)
    assert [r["a"] for r in store.rows(True).orderBy("__offset").collect()] == ["éé7", None]
    dead = spark.read.parquet(f"{tmp_path}/dead_letters/batch=0").collect()
    assert [(r["offset"], r["reason"]) for r in dead] == [(1, "longer than 3: a")]


def greedy(rows, max_records, max_bytes, gap):
    """(first, last, bytes, rows) of closed segments, one row after the other."""
    out, open_, last_ms = [], [], None
    for offset, ms, size in rows:
        if open_ and gap is not None and ms - last_ms >= gap:
            out.append(open_)
            open_ = []
        open_, last_ms = [*open_, (offset, size)], ms
        if (max_records and len(open_) >= max_records) or (max_bytes and sum(b for _, b in open_) >= max_bytes):
            out.append(open_)
            open_ = []
    return [(s[0][0], s[-1][0], sum(b for _, b in s), len(s)) for s in out]


RULES = [(3, None, None), (None, 100, None), (4, 120, None), (5, 150, 3000), (None, None, 2500)]


@pytest.fixture(scope="module")
def arrivals():
    rng, ms, out = random.Random(9), 0, []
    for offset in range(120):
        ms += rng.choice([100, 900, 2500, 3000])
        out.append((offset, ms, rng.choice([0, 10, 40, 130])))
    return out


def in_files(spark, source, rows, cuts):
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        df = spark.createDataFrame(rows[max(0, a - 2) : b], "offset bigint, ms bigint, size bigint")
        df = df.selectExpr("'t' topic", "0 partition", "offset", "timestamp_millis(ms) timestamp", "cast(size as string) value")
        df.coalesce(1).write.mode("append").parquet(source)


@pytest.mark.parametrize("max_records,max_bytes,gap", RULES)
def test_live_closing_is_that_of_one_row_after_the_other(arrivals, max_records, max_bytes, gap):
    """The state function alone, over batches that overlap and are out of order inside."""
    close = segment_closer(max_records, max_bytes, gap)
    state, out, rng = FakeState(), [], random.Random(3)
    for a, b in ((0, 1), (1, 40), (38, 41), (41, 41), (41, 120)):
        some = pd.DataFrame(rng.sample(arrivals[a:b], b - a), columns=["offset", "ms", "size"])
        out += [tuple(r)[3:] for f in close(("t", 0), iter([some]), state) for r in f.itertuples(index=False)]
    assert out == greedy(arrivals, max_records, max_bytes, gap)


class FakeState:
    exists, hasTimedOut, get = False, False, None

    def update(self, value):
        self.exists, self.get = True, value

    def setTimeoutDuration(self, _):
        pass


def test_a_stream_is_tracked_over_micro_batches(spark, arrivals, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    in_files(spark, source, arrivals, (7, 50, 51))
    stream = read_topic(spark, "parquet", {"maxFilesPerTrigger": "1"}, source, streaming=True)
    o = Options(max_records=5, idle="3s")
    track_segments(stream, out, o, check, F.col("value").cast("bigint")).awaitTermination()
    store = Store(spark, out)
    assert store.log.last().batch == 3
    found = store.manifest(o).filter("closed").orderBy("segment").collect()
    assert [(r["first_offset"], r["last_offset"], r["bytes"], r["rows"]) for r in found] == greedy(arrivals, 5, None, 3000)


def test_live_closing_keeps_state_across_batches(spark, topic, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for n, first in ((5, 0), (5, 5), (2, 8)):
        topic(payloads(n, first), first=first).coalesce(1).write.mode("append").parquet(source)
    stream = read_topic(spark, "parquet", {"maxFilesPerTrigger": "1"}, source, streaming=True)
    closed = closed_segments(stream, max_records=4, size=F.lit(10))
    query = closed.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
    query.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema(closed.schema).parquet(out).orderBy("segment").collect()
    assert [(r["segment"], r["first_offset"], r["last_offset"], r["rows"], r["bytes"]) for r in rows] == [
        (0, 0, 3, 4, 40), (1, 4, 7, 4, 40)
    ]


def test_idle_timer_closes_a_segment_without_new_rows(spark, topic, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    topic(payloads(3)).coalesce(1).write.parquet(source)
    closed = closed_segments(read_topic(spark, "parquet", path=source, streaming=True), idle="2s", size=F.lit(1))
    query = closed.writeStream.format("parquet").option("path", out).option("checkpointLocation", check)
    query = query.trigger(processingTime="1 second").start()
    rows, waited = [], time.monotonic()
    while not rows and query.isActive and time.monotonic() - waited < 60:
        time.sleep(1)
        if glob.glob(f"{out}/*.parquet"):
            rows = spark.read.schema(closed.schema).parquet(out).collect()
    query.stop()
    assert [(r["first_offset"], r["last_offset"], r["rows"]) for r in rows] == [(0, 2, 3)]


def test_idle_sessions(topic):
    df = topic(["x"] * 6).withColumn("timestamp", F.timestamp_seconds(F.when(F.col("offset") < 3, F.col("offset")).otherwise(F.col("offset") + 100)))
    rows = idle_sessions(df, "60s", "0 seconds").orderBy("first_offset").collect()
    assert [(r["first_offset"], r["last_offset"], r["rows"]) for r in rows] == [(0, 2, 3), (3, 5, 3)]


def test_segment_files_and_row_groups(spark, topic, tmp_path):
    path = str(tmp_path / "s")
    df = topic([f"{i:064d}" for i in range(4000)])
    write_segments(segment(df, max_records=2000).drop("timestamp"), path, row_group_bytes=10_240)
    files = glob.glob(f"{path}/topic=t/partition=0/segment=*/*.parquet")
    assert len(files) >= 2
    meta = pq.ParquetFile(files[0]).metadata
    assert meta.num_row_groups > 1 and meta.row_group(0).column(0).compression == "SNAPPY"


def test_latest_row_per_key(spark, topic):
    rows = topic(['{"field1":"a","field2":1}', '{"field1":"b","field2":2}', '{"field1":"a","field2":3}'])
    out = transform(rows, Options(keys="field1", continue_on_invalid=True)).valid.select("value.*")
    assert sorted(r["__order"] for r in out.collect()) == [0, 1, 2]
    assert {(r["field1"], r["field2"], r["__order"]) for r in latest_per_key(out, ["field1"], "__order").collect()} == {
        ("a", 3, 2), ("b", 2, 1)
    }
    with pytest.raises(ValueError, match="not in the frame: when"):
        latest_per_key(out, ["field1"], "when")


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(100).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.lit("x").alias("v"))
    plan = latest_per_key(df, ["k"], "o")._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_upsert(spark, tmp_path):
    path = str(tmp_path)
    first = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 5, "c")], "k int, o int, v string")
    second = spark.createDataFrame([(1, 3, True), (2, 4, False), (3, 1, True)], "k int, o int, f boolean")
    upsert_table(spark, path, first, ["k"], "o", 0)
    upsert_table(spark, path, second, ["k"], "o", 1)
    got = {tuple(r) for r in read_table(spark, path, 1).collect()}
    assert got == {(1, 3, None, True), (2, 5, "c", None), (3, 1, None, True)}
    assert merge_latest(first, second, ["k"], "o").count() == 3


def test_column_widths(spark):
    df = spark.createDataFrame([("abc", "x", 1), ("ab", None, 2), ("abcd", "y", 3)], "a string, b string, n int")
    assert [tuple(r) for r in overlong_strings(df, 2).collect()] == [("a", 2, 4)]
    for bad in (0, 65001):
        with pytest.raises(ValueError):
            overlong_strings(df, bad)
    assert column_ddl(df.schema, 10) == "`a` VARCHAR(10), `b` VARCHAR(10), `n` int"
    assert column_ddl(df.schema) == "`a` string, `b` string, `n` int"
    made = create_target_sql("target", df.schema, 3)
    assert made == "CREATE TABLE IF NOT EXISTS target (`a` VARCHAR(3), `b` VARCHAR(3), `n` int) USING parquet"


def test_read_topic(spark, topic, tmp_path):
    topic(payloads(3)).write.parquet(str(tmp_path / "p"))
    df = read_topic(spark, "parquet", path=str(tmp_path / "p"))
    assert df.schema.names == TOPIC_SCHEMA.names and df.count() == 3
    other = spark.sql("select 5 as id, 'x' as body")
    made = as_topic(
        other, topic=F.lit("t"), partition=F.lit(0), offset=F.col("id"), timestamp=F.lit(None), value=F.col("body")
    )
    assert made.schema["offset"].dataType == T.LongType() and made.first()["value"] == "x"
    with pytest.raises(ValueError, match="no source for topic"):
        as_topic(other)
