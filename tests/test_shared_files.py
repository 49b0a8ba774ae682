"""Short segments share files, and streams take a growing topic in the order of its offsets."""

import glob

from pyspark.sql import functions as F

from topicflow import catalogue
from topicflow.operators.segment import segment
from topicflow.plans.ingest import Store, publish
from topicflow.plans.options import Options
from topicflow.sinks.parquet import write_segments


def test_published_segments_share_files(spark, topic, tmp_path):
    path = str(tmp_path / "out")
    options = Options(max_records=2, embed_metadata=False)
    publish(topic([f'{{"n":{i}}}' for i in range(200)]), 0, path, options)
    rows = Store(spark, path).rows(lineage=True).collect()
    assert sorted((r["n"], r["__segment"], r["__offset"]) for r in rows) == [(i, i // 2, i) for i in range(200)]
    assert len(glob.glob(f"{path}/data/**/*.parquet", recursive=True)) < 50  # of 100 segments


def test_a_batch_written_again_replaces_all_its_versions(spark, topic, tmp_path):
    path = str(tmp_path / "out")
    options = Options(embed_metadata=False)
    publish(topic(['{"n":1}', '{"n":"x"}', '{"n":2}']), 0, path, options)
    publish(topic(['{"n":1}', '{"n":3}']), 0, path, options)
    rows = Store(spark, path).rows(version=0).collect()
    assert sorted(r["n"] for r in rows) == [1, 3]
    assert not glob.glob(f"{path}/data/__batch=0/__schema=1/*.parquet")


def test_written_segments_share_files(spark, topic, tmp_path):
    path = str(tmp_path / "s")
    rows = segment(topic([str(i) for i in range(200)]), max_records=2).drop("timestamp")
    write_segments(rows, path, shared=True)
    found = spark.read.parquet(path)
    assert sorted((r["offset"], r["segment"]) for r in found.collect()) == [(i, i // 2) for i in range(200)]
    assert len(glob.glob(f"{path}/topic=t/partition=0/*.parquet")) < 50


def test_stream_of_a_topic_in_several_files(spark, tmp_path):
    """Each write of the growing topic is several files whose offsets overlap."""
    n = 4000
    events = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"),
        F.lit(8).cast("bigint").alias("user_id"), F.lit("view").alias("event_type"),
        F.lit(1.0).alias("value"), F.lit('{"k":1}').alias("props"),
    )
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    rows = catalogue.QUERIES["closed_segments_stream"](spark, str(tmp_path)).collect()
    size = catalogue.RECORDS
    assert sorted((r["segment"], r["first_offset"], r["last_offset"], r["rows"]) for r in rows) == [
        (i, i * size, (i + 1) * size - 1, size) for i in range(n // size)
    ]
