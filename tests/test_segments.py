import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicflow.operators.breaks import NEVER, Rows, apply_steps, compose
from topicflow.operators.epochs import decode_epochs, epoch_schemas, schema_epochs
from topicflow.operators.infer import shape_fields
from topicflow.operators.ordered import running
from topicflow.operators.replay import drop_replayed
from topicflow.operators.segment import (
    close_manifest,
    committed_offsets,
    mark_closed,
    millis,
    resume,
    segment,
    segment_manifest,
)


def make_rows(seed, partitions=2, n=150):
    rnd, rows = random.Random(seed), []
    for p in range(partitions):
        offset = ms = 0
        for _ in range(n):
            offset += rnd.choice([1, 1, 1, 2, 9])
            ms += rnd.choice([10, 20, 1000, 5000]) if rnd.random() < 0.1 else 5
            schema = rnd.choice("ab") if rnd.random() < 0.1 else "a"
            rows.append(("t", p, offset, ms, rnd.choice([0, 1, 5, 10, 50]), schema))
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(
        rows, "topic string, partition int, offset bigint, ms bigint, size bigint, sch string"
    )
    return df.withColumn("timestamp", F.timestamp_millis("ms")).repartition(4)


def one_by_one(rows, records, size, idle, by):
    """The rules read literally: after each row ask whether the segment is closed."""
    out, state = {}, {}
    for t, p, offset, ms, n, schema in sorted(rows):
        number, count, total, last = state.get(p, (0, 0, 0, None))
        if last is not None and (
            count >= records or total >= size or (idle and ms - last[0] >= idle) or (by and schema != last[1])
        ):
            number, count, total = number + 1, 0, 0
        out[p, offset] = number
        state[p] = (number, count + 1, total + n, (ms, schema))
    return out


RULES = [
    (7, None, None, None), (None, 100, None, None), (13, 100, None, None), (50, 300, 4000, "sch"),
    (None, None, 900, None), (None, None, None, "sch"), (None, None, 900, "sch"), (1, None, None, None),
]


@pytest.mark.parametrize("records, size, idle, by", RULES)
@pytest.mark.parametrize("bits", [6, 20])
def test_segments_match_row_by_row(spark, records, size, idle, by, bits):
    rows = make_rows(1)
    out = segment(frame(spark, rows), records, size, idle, by, F.col("size"), block_bits=bits)
    got = {(r["partition"], r["offset"]): r["segment"] for r in out.collect()}
    assert got == one_by_one(rows, records or 10**9, size or 10**9, idle, by)


def test_many_levels_of_blocks(spark):
    rows = make_rows(3, partitions=1, n=120)
    out = segment(frame(spark, rows), 9, 120, size=F.col("size"), block_bits=2)
    got = {(r["partition"], r["offset"]): r["segment"] for r in out.collect()}
    assert got == one_by_one(rows, 9, 120, None, None)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 9), st.booleans()), min_size=1, max_size=40),
    st.integers(1, 12), st.integers(1, 30), st.integers(1, 8), st.integers(0, 14), st.integers(0, 35),
)
def test_composed_blocks_equal_the_walk(rows, records, size, width, s1, s2):
    """Cutting rows into blocks and composing them changes nothing."""
    limit = (records, size)

    def as_rows(part):
        n = np.arange(len(part))
        sizes = np.array([r[0] for r in part])
        before = np.cumsum(sizes) - sizes
        forced = np.array([r[1] for r in part])
        return Rows((n, before), (-n, -before), (len(part), sizes.sum()), forced)

    whole = as_rows(rows)
    found = whole.walk((s1, s2), limit)
    blocks = [as_rows(rows[i : i + width]).steps(limit) for i in range(0, len(rows), width)]
    total = blocks[0]
    for b in blocks[1:]:
        total = compose(total, b, limit)
    for f in (total, whole.steps(limit)):
        e1, e2, n = apply_steps(f, [s1], [s2], limit)
        assert n[0] == len(found)
        if found:
            assert (e1[0], e2[0]) == (len(rows) - found[-1], sum(r[0] for r in rows[found[-1] :]))
        else:
            assert (e1[0], e2[0]) == (s1 + len(rows), s2 + sum(r[0] for r in rows))


def test_segments_go_on_from_open_ones(spark):
    rows = make_rows(5)
    expected = one_by_one(rows, 11, 90, 900, "sch")
    middle = sorted(rows)[60][2]
    first = [r for r in rows if r[2] <= middle]
    second = [r for r in rows if r[2] > middle]
    done = segment(frame(spark, first), 11, 90, 900, "sch", F.col("size"))
    state = (
        done.groupBy("topic", "partition", "segment")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.max("ms").alias("last_ts"), F.max_by("sch", "offset").alias("last_schema"))
        .groupBy("topic", "partition").agg(F.max_by(F.struct("segment", "rows", "bytes", "last_ts", "last_schema"), "segment").alias("s"))
        .select("topic", "partition", "s.*")
    )
    for bits in (5, 20):
        rest = segment(frame(spark, second), 11, 90, 900, "sch", F.col("size"), state, bits)
        got = {(r["partition"], r["offset"]): r["segment"] for r in rest.collect()}
        assert got == {k: v for k, v in expected.items() if k[1] > middle}


def test_one_shuffle_for_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    frame(spark, make_rows(1)).withColumn("wide", F.lit("x")).write.parquet(path)
    df = spark.read.parquet(path)
    for rules in (dict(max_records=5), dict(idle=900), dict(idle=900, by_schema="sch")):
        plan = segment(df, **rules)._jdf.queryExecution().executedPlan().toString()
        wide = [line for line in plan.splitlines() if "FileScan" in line and "wide#" in line]
        assert len(wide) == 1
        assert "Python" not in plan


def test_running_values(spark):
    rows = [("t", 0, o, v) for o, v in [(0, 3), (1, 1), (5, 9), (6, 2), (7, 4), (20, 1)]]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint, v bigint")
    for bits in (1, 2, 20):
        out = running(df, ["topic", "partition"], "offset", {"p": "v"}, {"s": "v"}, {"m": "v"}, bits).orderBy("offset")
        assert [(r["p"], r["s"], r["m"]) for r in out.collect()] == [
            (None, 3, None), (3, 4, 3), (1, 13, 3), (9, 15, 9), (2, 19, 9), (4, 20, 9)
        ]


def test_replayed_offsets_are_dropped(spark):
    rows = [("t", 0, o) for o in (1, 2, 2, 3, 3, 3)] + [("t", 1, 1)]
    df = spark.createDataFrame(rows, "topic string, partition int, offset bigint")
    committed = spark.createDataFrame([("t", 0, 1)], "topic string, partition int, offset bigint")
    assert {tuple(r) for r in drop_replayed(df, committed).collect()} == {("t", 0, 2), ("t", 0, 3), ("t", 1, 1)}
    arrived = [("t", 0, o, i) for i, o in enumerate([1, 3, 2, 3, 5, 4, 6])]
    df = spark.createDataFrame(arrived, "topic string, partition int, offset bigint, arrival bigint")
    for bits in (1, 20):
        kept = drop_replayed(df, arrival="arrival", block_bits=bits).collect()
        assert sorted(r["offset"] for r in kept) == [1, 3, 5, 6]


def test_close_rules_at_their_edges(spark):
    def closed(rows, size, last_ms, now_ms):
        df = spark.createDataFrame(
            [("t", 0, 0, 0, 9, size, rows, last_ms)],
            "topic string, partition int, segment bigint, first_offset bigint, last_offset bigint, bytes bigint, rows bigint, last_ts bigint",
        )
        now = F.timestamp_millis(F.lit(now_ms))
        return close_manifest(df, 10000, 10, "1min", now).first()["closed"]

    assert closed(1, 10, 0, 0) and not closed(1, 9, 0, 0)
    assert closed(10000, 1, 0, 0) and not closed(9999, 1, 0, 0)
    assert closed(1, 1, 0, 60_000) and not closed(1, 1, 0, 59_900)


def test_manifest_commit_and_resume(spark):
    rows = [("aTopic", 7, o, o, 41, "a") for o in (3, 4, 5)] + [("aTopic", 8, 1, 0, 1, "a")]
    out = segment(frame(spark, rows), max_records=2)
    manifest = segment_manifest(out, F.col("size"), max_records=2)
    names = {r["file_name"]: r["closed"] for r in manifest.collect()}
    assert names == {
        "topic-aTopic_partition-7_firstOffset-3_lastOffset-4_bytes-82_rows-2.parquet": True,
        "topic-aTopic_partition-7_firstOffset-5_lastOffset-5_bytes-41_rows-1.parquet": False,
        "topic-aTopic_partition-8_firstOffset-1_lastOffset-1_bytes-1_rows-1.parquet": False,
    }
    assert [tuple(r) for r in committed_offsets(manifest).collect()] == [("aTopic", 7, 4)]
    assert {(r["offset"], r["closed"]) for r in mark_closed(out, manifest).collect()} == {
        (3, True), (4, True), (5, False), (1, False)
    }
    assert {r["offset"] for r in resume(frame(spark, rows), manifest).collect()} == {5, 1}


def test_durations():
    assert [millis(x) for x in (5, "30s", "2min", "1h", "7 ms")] == [5, 30_000, 120_000, 3_600_000, 7]
    with pytest.raises(ValueError):
        millis("soon")
    with pytest.raises(ValueError):
        segment(None)


def greedy_epochs(payload_fields):
    epoch, known, out = -1, {}, []
    for fields in payload_fields:
        if epoch < 0 or any(known.get(p, t) != t for p, t in fields.items()):
            epoch, known = epoch + 1, {}
        known.update(fields)
        out.append(epoch)
    return out


def random_payloads(seed, n):
    rnd = random.Random(seed)
    values = {"a": ["1", '"x"'], "b": ["1", "1.5", '{"q":1}', '{"q":"y"}'], "c": ["true"], "d": ["[1]", '"t"', "3"]}
    out = []
    for _ in range(n):
        names = rnd.sample(sorted(values), rnd.randint(1, 3))
        out.append("{" + ",".join(f'"{k}":{values[k][0] if rnd.random() < 0.8 else rnd.choice(values[k])}' for k in names) + "}")
    return out


@pytest.mark.parametrize("bits", [4, 20])
def test_schema_epochs_match_row_by_row(spark, topic, bits):
    from topicflow.operators.infer import json_shape

    payloads = random_payloads(2, 90)
    df = topic(payloads)
    text_kinds = {"list": "string", "empty": "string"}
    shapes = [r["s"] for r in df.orderBy("offset").select(json_shape(F.col("value")).alias("s")).collect()]
    fields = [{tuple(p): text_kinds.get(t, t) for p, t in shape_fields(s)} for s in shapes]
    got = [r["epoch"] for r in schema_epochs(df, block_bits=bits).orderBy("offset").collect()]
    assert got == greedy_epochs(fields)


def test_type_change_resets_the_schema(topic):
    df = schema_epochs(topic(['{"berth":"east","port":"Oslo"}', '{"berth":22}']))
    frames = {tuple(s.names): [r["value"] for r in f.collect()] for s, f in decode_epochs(df)}
    assert set(frames) == {("berth", "port"), ("berth",)}
    assert frames[("berth",)][0]["berth"] == 22
    assert epoch_schemas(df).count() == 2


def test_int_text_int_resets_twice(topic):
    df = schema_epochs(topic(['{"a":1}', '{"a":2}', '{"a":"x"}', '{"a":3}']))
    assert [r["epoch"] for r in df.orderBy("offset").collect()] == [0, 0, 1, 2]
