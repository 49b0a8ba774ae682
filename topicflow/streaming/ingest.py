"""Structured Streaming ingest: every micro-batch is one published batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from topicflow.plans.ingest import publish
from topicflow.plans.options import Options


def ingest_stream(
    df: DataFrame,
    path: str,
    options: Options,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Publish a stream of topic rows; without ``interval`` what is there now, then stop.

    Open segments go on across micro-batches and restarts, because their
    counters are part of what a batch publishes.  A micro-batch that is run
    again after a failure replaces its own output.
    """

    def publish_batch(rows: DataFrame, batch: int) -> None:
        publish(rows, batch, path, options)

    writer = df.writeStream.foreachBatch(publish_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
