"""Language ID: averaged hashed subword embeddings with a linear softmax.

Subwords are the runs of two, three and four UTF-8 bytes of a text, lower-cased,
with each run of ASCII characters other than letters as one space; they are
hashed to BUCKETS rows of an embedding.  A text is the mean of its rows, then a
linear layer and softmax.  Stochastic gradient descent in numpy trains on a
bounded sample of labelled rows (``sample`` texts, shared out evenly among the
languages, in each those of the smallest id hashes).  Of a table with more than a tenth
of ``sample`` languages the most frequent so many are learned, 300 unless ``sample`` is
raised; documents in others get one of these or are rejected.  A part of it, unseen by training,
sets the temperature that calibrates the score and the score under which a
prediction is marked as rejected.  As the mean is linear, texts are scored with
the product of both layers, one row of logits per bucket.

Null texts and texts without a letter are ``und`` with score 0, and so is
everything where no labelled row is there to learn from.  Ties go to the language
that sorts first.  Rows with null or repeated ids are documents of their own.
Extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, slices

BUCKETS = 1 << 15
WIDTH = 16
LENGTHS = (2, 3, 4)
SAMPLE = 3000
EPOCHS = 4
#: Rejected is what scores below the calibration texts' lowest so many percent.
REJECT_PERCENT = 1.0

LETTER = re.compile(r"[^\W\d_]")
FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F))
SPACED = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def subwords(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Per length the bucket of the run that begins at each byte, and where each text begins.

    Runs that would leave their text, or begin with two spaces, are bucket -1.
    """
    raw = [(" " + t.lower() + " ").encode("utf-8", "surrogatepass") for t in texts]
    begins = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    data = SPACED[np.frombuffer(b"".join(raw), np.uint8)]
    left = np.repeat(begins[1:], np.diff(begins)) - np.arange(len(data))
    twice = np.zeros(len(data), bool)
    twice[:-1] = (data[:-1] == 32) & (data[1:] == 32)
    wide = data.astype(np.uint32)
    out, mixed = [], np.zeros(len(data), np.uint32)
    for k in range(max(LENGTHS)):
        moved = np.zeros(len(data), np.uint32)
        moved[: len(data) - k] = wide[k:] if k else wide
        mixed = (mixed ^ moved + np.uint32(1)) * FACTORS[k]
        if k + 1 in LENGTHS:
            bucket = (mixed >> np.uint32(17)).astype(np.int32) & (BUCKETS - 1)
            bucket[(left <= k) | twice] = -1
            out.append(bucket)
    return out, begins


def bucket_counts(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text with their share of its subwords."""
    runs, begins = subwords(texts)
    out = []
    for a, b in zip(begins, begins[1:]):
        own = np.concatenate([r[a:b] for r in runs])
        seen, n = np.unique(own[own >= 0], return_counts=True)
        out.append((seen, (n / max(1, n.sum())).astype(np.float32)))
    return out


def mean_logits(texts: list[str], rows: np.ndarray) -> np.ndarray:
    """Mean over a text's subwords of its buckets' rows of logits."""
    runs, begins = subwords(texts)
    padded = np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
    total = np.zeros((len(texts), rows.shape[1]))
    count = np.zeros(len(texts))
    for bucket in runs:
        for c in range(rows.shape[1]):
            total[:, c] += np.add.reduceat(padded[bucket, c], begins[:-1], dtype=np.float64)
        count += np.add.reduceat((bucket >= 0).astype(np.float64), begins[:-1])
    return total / np.maximum(count, 1)[:, None]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(
    samples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, seed: int = 7
) -> tuple[np.ndarray, float, float]:
    """(logits per bucket, temperature, score to reject under) by stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1, 1, (BUCKETS, WIDTH)).astype(np.float32) / WIDTH
    layer = np.zeros((WIDTH, classes), np.float32)
    order = rng.permutation(len(samples))
    # every fifth text of each language is held back, so one with few texts is still learned
    turn = np.zeros(len(order), np.int64)
    for c in range(classes):
        own = labels[order] == c
        turn[own] = np.arange(own.sum())
    held, used = order[turn % 5 == 4], order[turn % 5 != 4]
    steps, step = EPOCHS * max(1, len(used)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(used):
            rate = np.float32(1.0 * (1 - step / steps) + 0.01)
            step += 1
            seen, share = samples[i]
            mean = share @ embedding[seen]
            wrong = softmax(mean @ layer).astype(np.float32)
            wrong[labels[i]] -= 1
            back = layer @ wrong
            layer -= rate * np.outer(mean, wrong)
            embedding[seen] -= rate * 10 * share[:, None] * back[None, :]
    rows = embedding @ layer
    if not len(held):
        return rows, 1.0, 0.0
    logits = np.stack([samples[i][1] @ rows[samples[i][0]] for i in held])
    temperatures = np.exp(np.linspace(-2, 3, 51))
    own = np.arange(len(held)), labels[held]
    loss = [-np.log(softmax(logits / t)[own] + 1e-12).mean() for t in temperatures]
    temperature = float(temperatures[int(np.argmin(loss))])
    scores = softmax(logits / temperature).max(-1)
    return rows, temperature, float(np.percentile(scores, REJECT_PERCENT))


def sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("lang", pa.string()), ("seen", pa.list_(pa.int32())), ("share", pa.list_(pa.float32()))]
    )
    for batch in slices(batches):
        found = bucket_counts(batch.column("text").to_pylist())
        yield batch_of(schema, batch.column("lang"), [s for s, _ in found], [n for _, n in found])


def rows_of(found: pa.Table, name: str) -> Iterator[pa.Array]:
    return (row.values for chunk in found.column(name).chunks for row in chunk)


def predict(languages: list[str], rows: np.ndarray | None, temperature: float, reject: float):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("lang_pred", pa.string()),
            ("score", pa.float64()),
            ("rejected", pa.bool_()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            letters = np.array([bool(t and LETTER.search(t)) for t in texts])
            names, scores = ["und"] * len(texts), np.zeros(len(texts))
            if rows is not None:
                chance = softmax(mean_logits([t or "" for t in texts], rows) / temperature)
                best = chance.argmax(1)
                names = [languages[b] if ok else "und" for b, ok in zip(best, letters)]
                scores = np.where(letters, chance.max(1), 0.0)
            rejected = (scores < reject) | ~letters
            yield batch_of(schema, batch.column("doc_id"), names, scores, rejected)

    return run


def identify(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, rejected.

    ``training`` says of each row whether the model may learn from its language.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(training, F.lit(False)).alias("training"),
    )
    learn = rows.where("training AND lang IS NOT NULL AND length(text) > 0")
    # languages are few; should a table have more, the most frequent are learned
    sizes = learn.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(sample // 10).collect()
    languages = sorted(r["lang"] for r in sizes)
    weights = None, 1.0, 0.0
    if languages:
        rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
        share = sample // len(languages)
        # ranks alone leave somewhat more rows than wanted, the count in each language the rest
        wanted = share + 6 * math.sqrt(share) + 10
        chosen = F.lit(False)
        for r in sizes:
            limit = int(min(1.0, wanted / r["count"]) * (1 << 30))
            chosen = chosen | ((F.col("lang") == r["lang"]) & (rank < limit))
        order = [rank, F.col("doc_id"), F.xxhash64("text")]
        place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
        few = learn.where(chosen).withColumn("place", place).where(F.col("place") <= share)
        # at most ``sample`` rows by now; the limit only has them sorted in one step
        few = few.orderBy(*order, "lang").limit(sample).select("lang", "text")
        found = few.mapInArrow(sample_counts, "lang string, seen array<int>, share array<float>")
        found = found.toArrow()
        place = {x: i for i, x in enumerate(languages)}
        # views of the Arrow buffers; numbers as Python objects would take ten times the memory
        samples = [
            (seen.to_numpy(zero_copy_only=False), share.to_numpy(zero_copy_only=False))
            for seen, share in zip(rows_of(found, "seen"), rows_of(found, "share"))
        ]
        labels = np.array([place[x] for x in found.column("lang").to_pylist()], np.int64)
        weights = train(samples, labels, len(languages))
    return rows.select("doc_id", "text").mapInArrow(
        predict(languages, *weights),
        "doc_id bigint, lang_pred string, score double, rejected boolean",
    )
