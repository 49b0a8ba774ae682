"""Substring dedup by sliding sentence spans.

A sentence ends at ``.``, ``!`` or ``?`` before white space, at a line break, and
before a word that begins with a capital.  From each sentence on, the shortest
run of at least ``sentences`` sentences with at least ``words`` words is hashed
(case and spacing aside).  Equal runs are joined over the whole corpus; every run
but the one with the smallest (doc_id, place) marks its sentences, and marked
sentences are removed.  Runs, not texts, are shuffled; the count and the first
place of a run are combined before the shuffle, and a run that very many
documents share is one row on its side of the join.

Null texts stay null and have no sentences.  Texts without a run long enough stay
as they are.  Rows equal in doc_id and text are one document and get the same
result; rows that share only the id are told apart by their text.  Null ids sort
first.  Extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, slices

SENTENCES = 2
WORDS = 20
BOUNDARY = re.compile(r"(?<=[.!?])\s+|\s*\n\s*|\s+(?=[A-ZÀ-ÖØ-Þ])")


def split_sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of each sentence; the space between two belongs to neither."""
    out, start = [], 0
    for m in BOUNDARY.finditer(text):
        if m.start() > start:
            out.append((start, m.start()))
        start = m.end()
    if start < len(text):
        out.append((start, len(text)))
    return out


def runs(text: str, sentences: int, words: int) -> Iterator[tuple[int, int, bytes]]:
    """(first sentence, last sentence, hash) of the shortest long enough run from each one on."""
    from xxhash import xxh3_128_digest

    parts = [text[a:b].lower().split() for a, b in split_sentences(text)]
    joined = [" ".join(p) for p in parts]
    last, total = -1, 0
    for first in range(len(parts)):
        while last + 1 < len(parts) and (total < words or last - first + 1 < sentences):
            last += 1
            total += len(parts[last])
        if total < words or last - first + 1 < sentences:
            return
        run = " ".join(joined[first : last + 1])
        yield first, last, xxh3_128_digest(run.encode("utf-8", "surrogatepass"))
        total -= len(parts[first])


def hash_runs(sentences: int, words: int):
    schema = pa.schema(
        [
            ("hash", pa.binary()),
            ("doc_id", pa.int64()),
            ("sum", pa.int32()),
            ("first", pa.int32()),
            ("last", pa.int32()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [
                (h, doc_id, check, first, last)
                for doc_id, text, check in zip(*(c.to_pylist() for c in batch.columns))
                if text
                for first, last, h in runs(text, sentences, words)
            ]
            if rows:
                yield batch_of(schema, *zip(*rows))

    return run


def without(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the sentences of the spans, their number, and that of all sentences."""
    cuts = split_sentences(text)
    gone = set()
    for first, last in spans:
        gone.update(range(first, last + 1))
    out, end = [], 0
    for i, (start, stop) in enumerate(cuts):
        if i not in gone:
            out += [text[end:start] if out or not start else "", text[start:stop]]
        end = stop
    if not gone:
        return text, 0, len(cuts)
    return "".join(out), len(gone), len(cuts)


def remove_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_sentences", pa.int64()),
            ("n_removed", pa.int64()),
            ("first_docs", pa.list_(pa.int64())),
            ("text", pa.string()),
        ]
    )
    for batch in slices(batches):
        rows = []
        for doc_id, text, spans, docs in zip(*(c.to_pylist() for c in batch.columns)):
            pairs = [(s["first"], s["last"]) for s in spans or []]
            kept, removed, total = without(text, pairs) if text is not None else (None, 0, 0)
            rows.append((doc_id, total, removed, docs or [], kept))
        yield batch_of(schema, *zip(*rows))


def drop_repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sentences: int = SENTENCES,
    words: int = WORDS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_sentences, n_removed, first_docs, text.

    ``first_docs`` are the documents that keep what was removed here.
    """
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.hash(F.col(text_col).cast("string")).alias("sum"),
    )
    found = docs.mapInArrow(
        hash_runs(sentences, words), "hash binary, doc_id bigint, sum int, first int, last int"
    )
    place = F.struct("doc_id", "sum", "first")
    repeated = (
        found.groupBy("hash")
        .agg(F.min(place).alias("least"), F.count("*").alias("n"))
        .where("n > 1")
        .select("hash", "least")
    )
    again = found.join(repeated, "hash").where(place != F.col("least"))
    marked = again.groupBy("doc_id", "sum").agg(
        F.collect_list(F.struct("first", "last")).alias("spans"),
        F.sort_array(F.collect_set("least.doc_id")).alias("first_docs"),
    )
    same = docs["doc_id"].eqNullSafe(marked["doc_id"]) & docs["sum"].eqNullSafe(marked["sum"])
    joined = docs.join(marked, same, "left").select(
        docs["doc_id"], docs["text"], marked["spans"], marked["first_docs"]
    )
    return joined.mapInArrow(
        remove_spans,
        "doc_id bigint, n_sentences bigint, n_removed bigint, first_docs array<bigint>, text string",
    )
