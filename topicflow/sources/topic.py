"""Topic rows from Kafka or from files that hold the same envelope."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The envelope of Spark's Kafka source, as far as it is used.
TOPIC_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("value", T.StringType()),
    ]
)


def read_topic(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
    streaming: bool = False,
) -> DataFrame:
    """Envelope rows.  ``source`` is ``kafka`` or a file format such as ``parquet``.

    Kafka needs Spark's Kafka module on the classpath and its usual options
    (``kafka.bootstrap.servers``, ``subscribe`` with one or more topics; for
    streams set ``maxOffsetsPerTrigger``).
    """
    reader = (spark.readStream if streaming else spark.read).format(source)
    reader = reader.options(**dict(options or {}))
    if source == "kafka":
        return as_topic(reader.load())
    return as_topic(reader.schema(schema or TOPIC_SCHEMA).load(path))


def as_topic(df: DataFrame, **columns: Column) -> DataFrame:
    """Any frame as topic rows; ``columns`` says how to derive envelope columns."""
    missing = [n for n in TOPIC_SCHEMA.names if n not in df.columns and n not in columns]
    if missing:
        raise ValueError(f"no source for {', '.join(missing)}")
    wanted = {n: columns.get(n, F.col(n) if n in df.columns else None) for n in TOPIC_SCHEMA.names}
    kinds = {"topic": "string", "partition": "int", "offset": "bigint", "timestamp": "timestamp"}
    return df.select(
        *[c.cast(kinds[n]).alias(n) if n in kinds else c.alias(n) for n, c in wanted.items()]
    )
