"""Schema epochs: a type conflict along a topic-partition starts a new schema."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicflow.operators.breaks import NEVER, Rows, find_breaks
from topicflow.operators.decode import decode_json
from topicflow.operators.evolve import SchemaConflict
from topicflow.operators.infer import bounded, json_shape, schema_from_fields, shape_fields
from topicflow.operators.ordered import BLOCK, BLOCK_BITS, block_of, fill_from_marks, running
from topicflow.records import TOPIC_PARTITION, measured
from topicflow.session import keep_last_of_repeated_keys, materialise

KEYS = list(TOPIC_PARTITION)
MOST_SHAPES = 10_000
# Inferred kinds that share one column type.
TEXT_KINDS = ("list", "empty", "string")


def _explode_shapes(keep: list[str]):
    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = {shape: shape_fields(shape) for shape in batch["shape"].unique()}
            batch = batch.assign(field=batch["shape"].map(known)).explode("field")
            batch = batch[batch["field"].notna()]
            yield batch[keep].assign(
                path=batch["field"].str[0], type=batch["field"].str[1]
            )

    return explode


def schema_epochs(
    df: DataFrame, column: str = "value", block_bits: int = BLOCK_BITS
) -> DataFrame:
    """Add ``epoch``, counted from 0 per topic-partition along the offset.

    Rows add fields to the schema of their epoch.  A row with another type for
    a field the epoch already has starts the next epoch with its own schema.
    An epoch that began at ``s`` therefore ends at the first row that conflicts
    with a row at or after ``s``; only rows where a field changes type compared
    with its previous appearance can be that row.
    """
    keep_last_of_repeated_keys(df.sparkSession)
    shaped = df.select(
        *KEYS,
        F.col("offset").cast("bigint").alias("offset"),
        json_shape(F.col(column).cast("string")).alias("shape"),
    )
    # payloads are parsed once; everything below works on shapes
    shaped = materialise(shaped.filter(F.col("shape").startswith("OBJECT<")))
    previous = running(shaped, KEYS, "offset", previous={"before": "shape"}, block_bits=block_bits)
    # rows of one shape in sequence cannot conflict, so only run starts go on
    runs = previous.filter(F.col("before").isNull() | (F.col("before") != F.col("shape"))).drop("before")
    schema = T.StructType([f for f in runs.schema if f.name != "shape"])
    schema = schema.add("path", T.ArrayType(T.StringType())).add("type", "string")
    fields = runs.mapInPandas(_explode_shapes([*KEYS, "offset"]), schema).withColumn(
        "type", F.when(F.col("type").isin(*TEXT_KINDS), "string").otherwise(F.col("type"))
    )
    fields = running(
        materialise(fields), [*KEYS, "path"], "offset",
        previous={"type_before": "type", "offset_before": "offset"}, block_bits=block_bits,
    )
    conflicts = fields.filter(F.col("type") != F.col("type_before")).select(
        *KEYS, "offset", F.col("offset_before").alias("against")
    )
    # one quiet row per block, so that every block gets a mark
    quiet = (
        df.withColumn("offset", F.col("offset").cast("bigint"))
        .groupBy(*KEYS, block_of("offset", block_bits).alias(BLOCK))
        .agg(F.min("offset").alias("offset"))
        .select(*KEYS, "offset", F.lit(-1).cast("bigint").alias("against"))
    )
    rows = conflicts.unionAll(quiet).groupBy(*KEYS, "offset").agg(F.max("against").alias("against"))
    marks = find_breaks(
        materialise(rows), KEYS, "offset", _conflict_rows, (0, NEVER), None, block_bits
    ).withColumnRenamed("number", "epoch")
    return fill_from_marks(df, marks, KEYS, "offset", ["epoch"], block_bits)


def _conflict_rows(block: pd.DataFrame) -> Rows:
    offset = block["offset"].to_numpy(np.int64)
    against = np.maximum.accumulate(block["against"].to_numpy(np.int64))
    nothing = np.zeros(len(block), np.int64)
    return Rows((against, nothing), (-offset, nothing), (0, 0), nothing.astype(bool))


def epoch_fields(df: DataFrame, column: str = "value") -> DataFrame:
    """(topic, partition, epoch, path, type, first, rows) of frames with ``epoch``."""
    keep_last_of_repeated_keys(df.sparkSession)
    shapes = (
        df.select(
            *KEYS, "epoch", F.col("offset").cast("bigint").alias("offset"),
            json_shape(F.col(column).cast("string")).alias("shape"),
        )
        .filter(F.col("shape").startswith("OBJECT<"))
        .groupBy(*KEYS, "epoch", "shape")
        .agg(F.min("offset").alias("first"), F.count("*").alias("rows"))
    )
    keep = [*KEYS, "epoch", "first", "rows"]
    schema = T.StructType([shapes.schema[k] for k in keep])
    schema = schema.add("path", T.ArrayType(T.StringType())).add("type", "string")
    return (
        shapes.mapInPandas(_explode_shapes(keep), schema)
        .groupBy(*KEYS, "epoch", "path", "type")
        .agg(F.min("first").alias("first"), F.sum("rows").alias("rows"))
    )


def epoch_schemas(df: DataFrame, column: str = "value") -> DataFrame:
    """(topic, partition, epoch, fields): one sorted field list per epoch."""
    return (
        epoch_fields(df, column)
        .groupBy(*KEYS, "epoch")
        .agg(F.sort_array(F.collect_list(F.struct("path", "type"))).alias("fields"))
    )


def split_epochs(
    df: DataFrame, column: str = "value", **how: bool
) -> list[tuple[T.StructType, DataFrame]]:
    """(schema, rows) for each version that the epochs of a frame with ``epoch`` fit into.

    Distinct epoch schemas are folded on the driver, without their rows, in the
    order of their first offsets: each joins the newest version it does not
    conflict with.  ``how`` goes to ``schema_from_fields``.  Rows of epochs
    without any readable record come with the first version.
    """
    fields = materialise(epoch_fields(df, column))
    schemas = fields.groupBy(*KEYS, "epoch").agg(
        F.sort_array(F.collect_list(F.struct("path", "type"))).alias("fields"),
        F.min("first").alias("first"),
    )
    distinct = schemas.groupBy("fields").agg(F.min(F.struct("first", *KEYS)).alias("at"))
    distinct = sorted(bounded(distinct, MOST_SHAPES, "schemas"), key=lambda r: tuple(r["at"]))
    if not distinct:
        return [(T.StructType(), df)]
    versions: list[dict] = []
    numbers = []
    for row in distinct:
        new = {(tuple(f["path"]), f["type"]): 0 for f in row["fields"]}
        number = next((n for n in reversed(range(len(versions))) if _fits(versions[n] | new, how)), len(versions))
        if number == len(versions):
            versions.append({})
        versions[number] |= new
        numbers.append((row["fields"], number))
    schema = T.StructType([schemas.schema["fields"], T.StructField("__version", T.IntegerType())])
    numbered = df.sparkSession.createDataFrame(numbers, schema)
    placed = measured(schemas.join(numbered, "fields").select(*KEYS, "epoch", "__version"))
    seen = fields.join(placed, [*KEYS, "epoch"]).groupBy("__version", "path", "type")
    seen = bounded(seen.agg(F.min("first").alias("first"), F.sum("rows").alias("rows")))
    rows = df.join(placed, [*KEYS, "epoch"], "left").fillna(0, ["__version"])
    return [
        (
            schema_from_fields([r for r in seen if r["__version"] == n], **how),
            rows.filter(F.col("__version") == n).drop("__version"),
        )
        for n in range(len(versions))
    ]


def _fits(fields: dict, how: dict) -> bool:
    try:
        schema_from_fields([{"path": p, "type": t, "first": n} for (p, t), n in fields.items()], **how)
    except SchemaConflict:
        return False
    return True


def decode_epochs(df: DataFrame, column: str = "value") -> list[tuple[T.StructType, DataFrame]]:
    """One decoded frame per version of a frame with ``epoch``."""
    return [
        (schema, decode_json(part, schema, column)) for schema, part in split_epochs(df, column)
    ]
