"""Shared by the operators of this folder: splits, Arrow helpers, staged tables."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.session import checkpoint_folder

#: Text bytes that a Python function takes at a time from an Arrow batch.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any frame; null texts become empty ones."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def fold(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % n


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one that the cluster names in spark.checkpoint.dir."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write the frame to the shared folder and read it back, which cuts its lineage."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows written once with a number each, and the new column that holds it.

    Numbers depend on how a scan is split, so all that goes by them reads this table.
    """
    taken = {c.lower() for c in docs.columns}
    row = next(x for k in range(len(taken) + 1) if (x := f"row_{k}") not in taken)
    return stage(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text, or of one longer row."""
    import numpy as np

    for batch in batches:
        col = batch.column(batch.schema.get_field_index(text))
        if not batch.num_rows:
            continue
        import pyarrow.compute as pc

        sizes = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + size, "right")))
            yield batch.slice(start, end - start)
            start = end


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)],
        schema=schema,
    )


def give_back() -> None:
    """Return memory that the allocators keep; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def prefix_totals(rows: DataFrame, key: str, size: str) -> DataFrame:
    """(key, base): sum of sizes under all smaller keys, for keys that count files or tasks.

    One row per file reaches the window, never one per record.
    """
    from pyspark.sql import Window

    totals = rows.groupBy(key).agg(F.sum(size).alias("total"))
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(key, F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
