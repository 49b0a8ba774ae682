"""Drop rows that were read before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.operators.ordered import BLOCK_BITS, running
from topicflow.records import TOPIC_PARTITION, measured

KEYS = list(TOPIC_PARTITION)


def after_committed(df: DataFrame, committed: DataFrame) -> DataFrame:
    """Rows beyond the committed ``offset`` of their topic-partition."""
    last = committed.select(*KEYS, F.col("offset").alias("__committed"))
    joined = df.join(measured(last), KEYS, "left")
    new = F.col("__committed").isNull() | (F.col("offset") > F.col("__committed"))
    return joined.filter(new).select(*[F.col(f"`{c}`") for c in df.columns])


def drop_replayed(
    df: DataFrame,
    committed: DataFrame | None = None,
    arrival: str | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """Each offset once, and only beyond ``committed`` (topic, partition, offset).

    With ``arrival``, a unique non-negative arrival number, a row also has to
    lie beyond every offset of its topic-partition that arrived before it.
    """
    if committed is not None:
        df = after_committed(df, committed)
    if arrival is None:
        # keyed by the whole offset and combined before the shuffle, so copies
        # of one row never pile up
        return df.dropDuplicates([*KEYS, "offset"])
    seen = running(df, KEYS, arrival, maxima={"__seen": "offset"}, block_bits=block_bits)
    fresh = F.col("__seen").isNull() | (F.col("offset") > F.col("__seen"))
    return seen.filter(fresh).drop("__seen")
