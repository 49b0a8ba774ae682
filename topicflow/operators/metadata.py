"""Lineage and order columns taken from the envelope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.records import at, record_schema, reject_collisions, with_record

# The lineage columns and, by default, the order column.
LINEAGE = ("kafkaPartition", "kafkaOffset", "kafkaTimestamp", "kafkaPartitionOffset")
ORDER_COLUMN = "__order"


def embed_metadata(
    df: DataFrame,
    column: str | None = None,
    lineage: bool = True,
    order_column: str | None = None,
) -> DataFrame:
    """Append lineage columns and, if named, an order column equal to the offset."""
    partition, offset = F.col("partition").cast("int"), F.col("offset").cast("bigint")
    added = []
    if lineage:
        millis = F.unix_millis(F.col("timestamp").cast("timestamp"))
        joined = F.concat_ws("_", partition.cast("string"), offset.cast("string"))
        added = list(zip(LINEAGE, (partition, offset, millis, joined)))
    if order_column:
        added.append((order_column, offset))
    if column is None:
        reject_collisions([(c, c) for c in df.columns] + [(f"added {n}", n) for n, _ in added])
        return df.withColumns(dict(added))
    own = [(f.name, at(column, [f.name])) for f in record_schema(df, column)]
    reject_collisions([(n, n) for n, _ in own] + [(f"added {n}", n) for n, _ in added])
    return with_record(df, column, own + added)


def order_column_for(keys: list[str], order_by: str | None = None) -> str | None:
    """No keys, no order column; else the user's field or the embedded one."""
    return (order_by or ORDER_COLUMN) if keys else None
