"""Parquet output: segments, dead letters, keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from topicflow.operators.latest import column_ddl, latest_per_key, merge_latest
from topicflow.records import INVALID

PARTITIONS = ("topic", "partition", "segment")


def row_group_bytes_for(row_group_bytes: int | None, max_bytes: int | None) -> int | None:
    """At least 1, and never more than a segment may hold."""
    if row_group_bytes is None:
        return None
    if row_group_bytes < 1:
        raise ValueError("row_group_bytes must be at least 1")
    return min(row_group_bytes, max_bytes) if max_bytes else row_group_bytes


def parquet_writer(
    df: DataFrame, mode: str = "append", row_group_bytes: int | None = None
) -> DataFrameWriter:
    writer = df.write.mode(mode).option("compression", "snappy")
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
        # the writer looks at its buffer only every so many rows
        writer = writer.option("parquet.page.size.row.check.min", "10")
        writer = writer.option("parquet.block.size.row.check.min", "10")
        writer = writer.option("parquet.page.size", str(max(1, row_group_bytes // 4)))
    return writer


def write_segments(
    df: DataFrame,
    path: str,
    mode: str = "append",
    row_group_bytes: int | None = None,
    max_bytes: int | None = None,
    shared: bool = False,
) -> None:
    """One folder per topic, partition and segment.

    With ``shared`` segments of a topic-partition share its folder and files, in order, and
    ``segment`` is a column there: for segments too short to be worth a file each.
    No shuffle here: segmented rows already lie together by topic, partition
    and offset block, so a long segment is written by several tasks.
    """
    size = row_group_bytes_for(row_group_bytes, max_bytes)
    folders = PARTITIONS
    if shared:
        folders, df = PARTITIONS[:2], df.sortWithinPartitions(*PARTITIONS)
    parquet_writer(df, mode, size).partitionBy(*folders).parquet(path)


def write_dead_letters(df: DataFrame, path: str, mode: str = "append") -> None:
    """The original envelope and payload with the reason."""
    parquet_writer(df.drop(INVALID), mode).parquet(path)


def upsert_table(
    spark: SparkSession,
    path: str,
    new: DataFrame,
    keys: Sequence[str],
    order: str,
    version: int,
    tiebreak: Sequence[str] = (),
) -> None:
    """Write version ``version`` of a keyed table: version - 1 merged with ``new``.

    A version is a folder of its own, so readers never see half a merge and a
    retried write replaces only itself.
    """
    if version > 0:
        old = spark.read.parquet(f"{path}/version={version - 1}")
        new = merge_latest(old, new, keys, order, tiebreak)
    else:
        new = latest_per_key(new, keys, order, tiebreak)
    parquet_writer(new, "overwrite").parquet(f"{path}/version={version}")


def read_table(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{path}/version={version}")


def read_latest(
    df: DataFrame, keys: Sequence[str], order: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Keyed view of an append-only table: cheap writes, duplicates removed on read."""
    return latest_per_key(df, keys, order, tiebreak)


def create_target_sql(
    table: str, schema: T.StructType, varchar_length: int | None = None
) -> str:
    """DDL of the target table; Spark then refuses text longer than the width."""
    return f"CREATE TABLE IF NOT EXISTS {table} ({column_ddl(schema, varchar_length)}) USING parquet"
