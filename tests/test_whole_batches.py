"""Batches without rules for segments, and staged tables that several tasks read."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from topicflow.plans import ingest
from topicflow.plans.options import Options
from topicflow.session import materialise

OPTIONS = Options(keys="k", order_by="at", embed_metadata=False, table="t", buckets=4)


def records(first, n, kind):
    return [f'{{"k":"k{i % 3}","at":{i},"v":"{kind}{i}"}}' for i in range(first, first + n)]


def test_rows_are_placed_without_a_table_of_cuts(spark, topic, tmp_path, monkeypatch):
    staged, stage = [], ingest.materialise
    monkeypatch.setattr(ingest, "materialise", lambda df: staged.append(df.columns) or stage(df))
    path, far = str(tmp_path), 1 << 20  # the second topic's rows are in two blocks
    first = topic(records(0, 5, "a")).unionAll(topic(records(0, 4, "b"), "u", 1, far - 2))
    copies = topic(records(0, 5, "a")).unionAll(first)
    ingest.publish(copies, 0, path, OPTIONS)
    assert len(staged) == 2  # the source and the decoded rows
    second = topic(records(5, 2, "c"), first=5).unionAll(topic(records(0, 1, "d"), "w"))
    for _ in range(2):
        ingest.publish(second, 1, path, OPTIONS)
    store = ingest.Store(spark, path)
    found = sorted(tuple(r) for r in store.rows(lineage=True).drop("k", "at").collect())
    want = [(f"a{i}", "t", 0, 0, i) for i in range(5)] + [(f"b{i}", "u", 1, 0, far - 2 + i) for i in range(4)]
    assert found == sorted([*want, ("c5", "t", 0, 0, 5), ("c6", "t", 0, 0, 6), ("d0", "w", 0, 0, 0)])
    assert sorted(r.v for r in store.latest(OPTIONS).collect()) == ["a4", "c5", "c6"]
    parts = {(r.topic, r.partition, r.segment): r.rows for r in store.manifest(OPTIONS).collect()}
    assert parts == {("t", 0, 0): 7, ("u", 1, 0): 4, ("w", 0, 0): 1}


def test_a_large_staged_file_is_read_by_several_tasks(spark):
    rows = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).coalesce(1)
    staged = materialise(rows)
    (file,) = [f for path in staged.inputFiles() for f in glob.glob(path.removeprefix("file://"))]
    assert pq.ParquetFile(file).num_row_groups > 3
    assert staged.agg(F.count("*"), F.sum("id")).first()[:] == (400_000, 400_000 * 399_999 // 2)
