"""Segments of a stream as they close, without the rows themselves.

``track_segments`` keeps a manifest: each micro-batch is cut block by block in parallel,
and only one summary per segment joins what earlier ones left open.  ``closed_segments``
is a stream of its own with an idle timer per topic-partition; a micro-batch of one is one
call there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from topicflow.operators.segment import Rules, millis, payload_size
from topicflow.plans.ingest import track
from topicflow.plans.options import Options
from topicflow.records import TOPIC_PARTITION

KEYS = list(TOPIC_PARTITION)
CLOSED = (
    "topic string, partition int, segment bigint, first_offset bigint, last_offset bigint, "
    "bytes bigint, rows bigint"
)
OPEN = "segment bigint, first bigint, last bigint, bytes bigint, rows bigint, last_ms bigint"


def track_segments(
    df: DataFrame,
    path: str,
    options: Options,
    checkpoint: str,
    size: Column | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Cut a stream by the rules of ``options``; ``Store(spark, path).manifest(options)`` has the
    segments so far, ``closed`` or not.  ``size`` is what a row counts for in bytes."""
    size = (payload_size(df) if size is None else size).cast("bigint")
    query = df.withColumn("__counted", size).writeStream.foreachBatch(
        lambda rows, batch: track(rows, batch, path, options, F.col("__counted"))
    )
    query = query.option("checkpointLocation", checkpoint)
    query = query.trigger(processingTime=interval) if interval else query.trigger(availableNow=True)
    return query.start()


def closed_segments(
    df: DataFrame,
    max_records: int | None = None,
    max_bytes: int | None = None,
    idle: str | int | None = None,
    size=None,
) -> DataFrame:
    """One row per segment, emitted when it closes by rows, bytes or idle time.

    Offsets at or below the last one seen are ignored.  Only offset, size and
    time of a row reach the state function; limit micro-batches at the source
    (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``) to bound one call.
    With ``idle`` the query has timers to wait for, so it needs a
    ``processingTime`` trigger: ``availableNow`` would never end.
    """
    Rules(max_records, max_bytes, idle)
    gap = None if idle is None else millis(idle)
    narrow = df.select(
        *KEYS,
        F.col("offset").cast("bigint").alias("offset"),
        F.unix_millis("timestamp").alias("ms"),
        (payload_size(df) if size is None else size).cast("bigint").alias("size"),
    )

    timeout = (
        GroupStateTimeout.NoTimeout if gap is None else GroupStateTimeout.ProcessingTimeTimeout
    )
    close = segment_closer(max_records, max_bytes, gap)
    return narrow.groupBy(*KEYS).applyInPandasWithState(close, CLOSED, OPEN, "append", timeout)


def segment_closer(max_records: int | None, max_bytes: int | None, gap: int | None):
    """The state function of ``closed_segments``: one step per segment, not per row."""

    def close(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        number, first, last, total, rows, last_ms = (
            state.get if state.exists else (0, None, -1, 0, 0, None)
        )
        out = []

        def emit() -> None:
            out.append((*key, number, first, last, total, rows))

        if state.hasTimedOut:
            if rows:
                emit()
                number, first, total, rows = number + 1, None, 0, 0
        else:
            arrived = pd.concat(list(batches)).drop_duplicates("offset").sort_values("offset")
            arrived = arrived[arrived["offset"] > last]
            offsets, ms, sizes = (arrived[c].to_numpy(np.int64) for c in ("offset", "ms", "size"))
            upto = np.concatenate([[0], np.cumsum(sizes)])
            before = np.concatenate([[ms[:1].sum() if last_ms is None else last_ms], ms])[:-1]
            quiet = np.flatnonzero(ms - before >= gap) if gap is not None else np.empty(0, np.int64)
            at, n = 0, len(offsets)
            while at < n:  # once per segment
                if rows and len(quiet) and quiet[np.searchsorted(quiet, at) % len(quiet)] == at:
                    emit()
                    number, first, total, rows = number + 1, None, 0, 0
                ends, full = n, False
                if max_records and at + max_records - rows <= ends:
                    ends, full = at + max_records - rows, True
                if max_bytes:
                    here = int(np.searchsorted(upto[1:], upto[at] + max_bytes - total)) + 1
                    here = max(here, at + 1)
                    if here < ends or (here == ends and here <= n):
                        ends, full = here, True
                gaps = np.searchsorted(quiet, at, "right")
                if gaps < len(quiet) and quiet[gaps] < ends:
                    ends, full = int(quiet[gaps]), False
                first = int(offsets[at]) if first is None else first
                last, last_ms = int(offsets[ends - 1]), int(ms[ends - 1])
                total, rows, at = total + int(upto[ends] - upto[at]), rows + ends - at, ends
                if full:
                    emit()
                    number, first, total, rows = number + 1, None, 0, 0
        state.update((number, first, last, total, rows, last_ms))
        if gap is not None and rows:
            state.setTimeoutDuration(gap)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in CLOSED.split(", ")])

    return close


def idle_sessions(df: DataFrame, idle: str, lateness: str) -> DataFrame:
    """Rows and offsets per idle-delimited segment by event time, watermark included."""
    session = F.session_window("timestamp", f"{millis(idle)} milliseconds")
    return (
        df.withWatermark("timestamp", lateness)
        .groupBy(*KEYS, session.alias("session"))
        .agg(
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
            F.count("*").alias("rows"),
        )
    )
