"""Documents to packed token sequences: toxicity, near-dedup, decontamination, PII, packing.

Near-dedup proposes pairs by SimHash fingerprints, joined on segment popcounts, and by MinHash
keys those that fingerprints at a few bits miss, and checks their shingles exactly.  Null texts count as empty:
they pass toxicity by the classifier's bias, empty ones are copies of each other, and one
stays as a sequence piece of a single end id.  Rows with null or repeated ids are documents
of their own, ties keep the smallest id, texts of any length are read whole, extra columns
stay up to the last stage, and empty tables give no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.llm import decontaminate, near_copies, packing, pii, toxicity
from topicflow.llm.common import fold, new_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled training fold."""
    labels = table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, labels, fold("doc_id", 5) != 0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with 0.8 or more of their runs of five words in common the smallest id stays."""
    return near_copies.drop_near_copies(docs, width=5, similarity=0.8)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten words in a row of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs, length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of 4096 tokens."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, path, end_id=2, length=4096, with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminated),
    ("pii", redact),
    ("packing", pack),
]

#: SQL has no hashing like XXH64, no tokenizer and no training; the tests hold brute force against it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
