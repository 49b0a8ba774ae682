"""Concatenate and cut: all documents end to end, cut into windows of a fixed length.

Two passes.  The first tokenizes and stages, per task, its documents with their
place among the task's ids.  Prefix sums over the tasks' totals then give every
document its global place without moving it, and the second pass cuts.  All
sequences but the last are full; a document that crosses a boundary leaves one
piece, the boundary record, on each side.

Null texts are empty ones and have the end id alone; a null or repeated doc_id is
a document of its own; extra columns are left out; an empty table gives no rows.
The order of documents is that of the table's files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, documents, give_back, prefix_totals, slices, stage
from topicflow.llm.tokens import BATCH_BYTES, encoder, id_type

LOCAL = pa.schema(
    [
        ("task", pa.int32()),
        ("doc_id", pa.int64()),
        ("before", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("ids", pa.binary()),
    ]
)
PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)
PIECE_DDL = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def tokenize(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, dtype = encoder(path), id_type(path)
        end, width = np.array([end_id], dtype).tobytes(), int(dtype[-1])
        task, place = TaskContext.get().partitionId(), 0
        for batch in slices(batches, size=BATCH_BYTES):
            ids = [x + end for x in code.encode(batch.column("text"))]
            sizes = np.array([len(x) // width for x in ids], np.int64)
            before = place + np.concatenate([[0], np.cumsum(sizes)[:-1]])
            place += int(sizes.sum())
            yield batch_of(LOCAL, [task] * len(ids), batch.column("doc_id"), before, sizes, ids)
            del ids
            give_back()

    return run


def cut(length: int, dtype: str, with_ids: bool):
    schema = PIECE if with_ids else pa.schema(list(PIECE)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, first, total, raw in zip(*(batch.column(i) for i in range(4))):
                doc, first, total = doc.as_py(), first.as_py(), total.as_py()
                ids = np.frombuffer(raw.as_buffer(), dtype).astype("<u4")
                at = 0
                while at < total:
                    sequence, offset = divmod(first + at, length)
                    piece = ids[at : at + length - offset]
                    crc = zlib.crc32(piece.tobytes())
                    row = (doc, at, len(piece), crc, total, sequence, offset)
                    rows.append((*row, piece) if with_ids else row)
                    at += len(piece)
            if rows:
                yield batch_of(schema, *zip(*rows))

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    length: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece of a document: which of its ids, and where they stand."""
    dtype = id_type(tokenizer)
    local = documents(docs, id_col, text_col).mapInArrow(
        tokenize(tokenizer, end_id),
        "task int, doc_id bigint, before bigint, doc_tokens bigint, ids binary",
    )
    local = stage(local, "packing")
    bases = prefix_totals(local, "task", "doc_tokens")
    placed = local.join(bases, "task").select(
        "doc_id", (F.col("base") + F.col("before")).alias("first"), "doc_tokens", "ids"
    )
    return placed.mapInArrow(
        cut(length, dtype, with_ids), PIECE_DDL + ", ids array<int>" * with_ids
    )


def sequences(pieces: DataFrame, length: int = 4096, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, n_real): the packed sequences; a last short one is padded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.flatten(F.transform(parts, lambda p: p["ids"]))
    rows = pieces.groupBy("sequence_id").agg(ids.alias("ids"))
    padding = F.array_repeat(F.lit(pad_id).cast("int"), length - F.size("ids"))
    return rows.select(
        "sequence_id", F.concat("ids", padding).alias("ids"), F.size("ids").alias("n_real")
    )
