"""Cut each topic-partition into segments, and what follows from that."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.operators.breaks import NEVER, Rows, find_breaks, key_spans
from topicflow.operators.flatten import KEEP_NULLS
from topicflow.operators.ordered import BLOCK, BLOCK_BITS, fill_from_marks, running, running_flags, with_block
from topicflow.operators.replay import after_committed
from topicflow.records import TOPIC_PARTITION, measured, quote

KEYS = list(TOPIC_PARTITION)
SIZE = "__size"
FORCED = "__forced"
MILLIS = {"ms": 1, "s": 1000, "m": 60_000, "min": 60_000, "h": 3_600_000, "d": 86_400_000}


def millis(duration: str | int) -> int:
    """``30_000`` or ``"30s"`` in milliseconds."""
    if isinstance(duration, int):
        return duration
    match = re.fullmatch(r"\s*(\d+)\s*(ms|s|min|m|h|d)\s*", duration)
    if not match:
        raise ValueError(f"{duration!r} is not a duration like '30s' or '5min'")
    return int(match[1]) * MILLIS[match[2]]


@dataclass(frozen=True)
class Rules:
    """When a segment ends; any rule that holds ends it and resets all counters."""

    max_records: int | None = None
    max_bytes: int | None = None
    idle: str | int | None = None
    schema: str | None = None  # column that identifies the row's schema

    def __post_init__(self) -> None:
        for name in ("max_records", "max_bytes"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be at least 1")
        if not any((self.max_records, self.max_bytes, self.idle, self.schema)):
            raise ValueError("at least one segment rule is needed")


def payload_size(df: DataFrame, column: str | None = None) -> Column:
    """Bytes a row counts for: the length of its JSON text."""
    record = F.struct(*[quote(c) for c in df.columns]) if column is None else F.col(quote(column))
    dtype = None if column is None else df.schema[column].dataType.typeName()
    text = record if dtype in ("string", "binary") else F.to_json(record, KEEP_NULLS)
    return F.octet_length(text).cast("bigint")


def _with_forced(df: DataFrame, rules: Rules, block_bits: int, last: DataFrame | None) -> DataFrame:
    """Flag rows that start a segment whatever was counted: idle gap, new schema."""
    watched = {}
    if rules.idle is not None:
        df = df.withColumn("__ts", F.unix_millis(F.col("timestamp").cast("timestamp")))
        watched["__last_ts"] = "__ts"
    if rules.schema is not None:
        df = df.withColumn("__schema", F.col(quote(rules.schema)).cast("string"))
        watched["__last_schema"] = "__schema"
    df = running(df, KEYS, "offset", previous=watched, block_bits=block_bits)
    if last is not None:
        carried = last.select(*KEYS, F.col("last_ts").alias("__open_ts"), F.col("last_schema").alias("__open_schema"))
        df = df.join(measured(carried), KEYS, "left")
        for name, c in (("__last_ts", "__open_ts"), ("__last_schema", "__open_schema")):
            if name in watched:
                df = df.withColumn(name, F.coalesce(name, c))
        df = df.drop("__open_ts", "__open_schema")
    forced = F.lit(False)
    if rules.idle is not None:
        gap = F.col("__ts") - F.col("__last_ts") >= millis(rules.idle)
        forced = forced | F.coalesce(gap, F.lit(False))
    if rules.schema is not None:
        changed = F.col("__schema") != F.col("__last_schema")
        forced = forced | F.coalesce(changed, F.lit(False))
    return df.withColumn(FORCED, forced).drop("__ts", "__schema", *watched)


def segment(
    df: DataFrame,
    max_records: int | None = None,
    max_bytes: int | None = None,
    idle: str | int | None = None,
    by_schema: str | None = None,
    size: Column | None = None,
    open_segments: DataFrame | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Add ``segment``, counted from 0 per topic-partition along the offset.

    A segment ends when it holds ``max_records`` rows or at least ``max_bytes``
    bytes, when the next row comes ``idle`` later, or when the next row has
    another value in the column ``by_schema``.  Offsets must be unique per
    topic-partition (see ``drop_replayed``).

    ``open_segments`` (topic, partition, segment, rows, bytes, last_ts,
    last_schema) continues the last segments of an earlier batch.
    """
    rules = Rules(max_records, max_bytes, idle, by_schema)
    names = df.columns
    if max_records and not (max_bytes or idle or by_schema) and open_segments is None:
        one = df.withColumn(SIZE, F.lit(1).cast("bigint"))
        counted = running(one, KEYS, "offset", totals={"__row": SIZE}, block_bits=block_bits)
        number = F.expr(f"(__row - 1) div {max_records}")
        return counted.withColumn("segment", number).drop(SIZE, "__row")
    if not (max_records or max_bytes) and open_segments is None:
        watched = {}
        if idle is not None:
            watched["__ts"] = F.unix_millis(F.col("timestamp").cast("timestamp"))
        if by_schema is not None:
            watched["__schema"] = F.col(quote(by_schema)).cast("string")

        def begins(now, before) -> Column:
            gap = now("__ts") - before("__ts") >= millis(idle) if idle is not None else F.lit(False)
            other = now("__schema") != before("__schema") if by_schema is not None else F.lit(False)
            return F.coalesce(gap, F.lit(False)) | F.coalesce(other, F.lit(False))

        flagged = running_flags(
            df.withColumns(watched), KEYS, "offset", list(watched), begins, "segment", block_bits
        )
        return flagged.select(*[quote(c) for c in names], "segment")

    size = payload_size(df) if size is None else size
    narrow = df.select(
        *KEYS,
        F.col("offset").cast("bigint").alias("offset"),
        *([F.col("timestamp")] if idle is not None else []),
        *([F.col(quote(by_schema))] if by_schema else []),
        (size if max_bytes else F.lit(0)).cast("bigint").alias(SIZE),
    )
    narrow = with_block(narrow, "offset", block_bits)
    spans = key_spans(narrow, KEYS)
    if idle is not None or by_schema:
        narrow = _with_forced(narrow, rules, block_bits, open_segments)
    else:
        narrow = narrow.withColumn(FORCED, F.lit(False))
    narrow = narrow.select(*KEYS, BLOCK, "offset", SIZE, FORCED)
    start = None
    if open_segments is not None:
        start = open_segments.select(
            *KEYS,
            F.col("rows").cast("bigint").alias("s1"),
            F.col("bytes").cast("bigint").alias("s2"),
            F.col("segment").cast("bigint").alias("breaks"),
        )
    marks = find_breaks(
        narrow, KEYS, "offset", _segment_rows, (max_records or NEVER, max_bytes or NEVER),
        start, block_bits, spans,
    ).withColumnRenamed("number", "segment")
    return fill_from_marks(df, marks, KEYS, "offset", ["segment"], block_bits).select(
        *[quote(c) for c in names], "segment"
    )


def _segment_rows(block: pd.DataFrame) -> Rows:
    before = np.arange(len(block), dtype=np.int64)
    sizes = block[SIZE].to_numpy(np.int64)
    total = int(sizes.sum())
    bytes_before = np.cumsum(sizes) - sizes
    return Rows(
        (before, bytes_before), (-before, -bytes_before), (len(block), total), block[FORCED].to_numpy(bool)
    )


def segment_manifest(
    df: DataFrame,
    size: Column | None = None,
    max_records: int | None = None,
    max_bytes: int | None = None,
    idle: str | int | None = None,
    now: Column | None = None,
) -> DataFrame:
    """One row per segment, with its file name and whether it is closed.

    The last segment of a topic-partition is open unless a row or byte limit is
    reached or, given ``now``, it has been idle long enough.
    """
    size = payload_size(df.drop("segment")) if size is None else size
    last_ts = F.max(F.unix_millis(F.col("timestamp").cast("timestamp")))
    found = df.groupBy(*KEYS, "segment").agg(
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.sum(size).alias("bytes"),
        F.count("*").alias("rows"),
        *([last_ts.alias("last_ts")] if "timestamp" in df.columns else []),
    )
    return close_manifest(found, max_records, max_bytes, idle, now)


def close_manifest(
    manifest: DataFrame,
    max_records: int | None = None,
    max_bytes: int | None = None,
    idle: str | int | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Add ``closed`` and ``file_name`` to (topic, partition, segment, offsets, bytes, rows)."""
    latest = manifest.groupBy(*KEYS).agg(F.max("segment").alias("__latest"))
    full = F.lit(False)
    if max_records:
        full = full | (F.col("rows") >= max_records)
    if max_bytes:
        full = full | (F.col("bytes") >= max_bytes)
    if idle is not None and now is not None:
        full = full | (F.unix_millis(now) - F.col("last_ts") >= millis(idle))
    return (
        manifest.join(latest, KEYS)
        .withColumn("closed", (F.col("segment") < F.col("__latest")) | full)
        .withColumn("file_name", file_name())
        .drop("__latest")
    )


# Fixed value: the pattern of file names.
def file_name() -> Column:
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("NA"))

    return F.concat(
        F.lit("topic-"), F.col("topic"),
        F.lit("_partition-"), text("partition"),
        F.lit("_firstOffset-"), text("first_offset"),
        F.lit("_lastOffset-"), text("last_offset"),
        F.lit("_bytes-"), text("bytes"),
        F.lit("_rows-"), text("rows"),
        F.lit(".parquet"),
    )


def committed_offsets(manifest: DataFrame) -> DataFrame:
    """Last offset of the last closed segment; topic-partitions without one are left out."""
    return manifest.filter("closed").groupBy(*KEYS).agg(F.max("last_offset").alias("offset"))


def mark_closed(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add ``closed`` to segmented rows.

    Only the open segments are joined: at most one per topic-partition.
    """
    still_open = manifest.filter(~F.col("closed")).select(*KEYS, F.col("segment").alias("__open"))
    return (
        df.join(measured(still_open), KEYS, "left")
        .withColumn("closed", F.coalesce(F.col("segment") != F.col("__open"), F.lit(True)))
        .drop("__open")
    )


def resume(df: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows to read again after a restart: all beyond the committed offsets."""
    return after_committed(df, committed_offsets(manifest))
