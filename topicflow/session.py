"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings that only make sense together with this package; a cluster's own
# values for memory, executors and shuffle partitions are left alone.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def keep_last_of_repeated_keys(spark: SparkSession) -> None:
    """A key that one object repeats keeps its last value wherever payloads are read.

    Set once and left, so that concurrent queries cannot see it change.
    """
    key = "spark.sql.variant.allowDuplicateKeys"
    spark.conf.set(key, SETTINGS[key])


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where nothing is set, on one machine in tests, a private one is made
    and set for the rest of the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="topicflow-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Row groups of staged tables, so that a file larger than its share is read by several tasks.
STAGED_GROUP_BYTES = 4 << 20

_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path), so that any shared storage works."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables that ``materialise`` writes inside are deleted at the end.

    For work that ends in files of its own; frames that read staged tables must
    not leave the block.
    """
    folders: list[str] = []
    before = _staged.set(folders)
    try:
        yield
    finally:
        _staged.reset(before)
        for folder in folders:
            delete_folder(spark, folder)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write the frame to the checkpoint folder and read it back.

    A written table survives the loss of executors, and unlike an eager
    checkpoint it runs the plan once, not twice.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/topicflow-{uuid.uuid4().hex}"
    folders = _staged.get()
    if folders is not None:
        folders.append(path)
    df.write.option("parquet.block.size", STAGED_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
