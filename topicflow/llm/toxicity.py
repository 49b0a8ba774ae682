"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. A bounded sample of labelled training rows (``sample`` of each label, those of
   the smallest id hashes) gives for each word, and each word beginning of four to
   seven bytes, the number of texts of either label that have it.
   Texts of the sample with the same set of words count once, all without words too.
2. The strongest VOTERS become lexicon voters (words) and pattern voters (beginnings);
   a few that shout or insult by form are fixed patterns.  A voter says toxic or
   abstains.
3. The label model takes the votes alone: expectation maximisation finds how
   often each voter fires on toxic and on other texts.  Voters that fire together
   beyond what the classes explain are correlated; each is weighted by one over
   the number that it goes along with.
4. A linear classifier over the FEATURES strongest words and beginnings learns the
   model's posteriors; weaker features have no part in either model.

Labels only choose the voters and the starting point of step 3.  Scores read the
text alone.  Null and empty texts score what the classifier's bias says.  Without
labelled rows of both kinds every score is 0.  Rows with null or repeated ids are
documents of their own; a document with several labels is used once for each.
Extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, slices, stage
from topicflow.llm.decontaminate import FOLD
from topicflow.llm.simhash import shingle_hashes

SAMPLE = 4000
VOTERS = 400
FEATURES = 4000
#: A feature must be in so many texts of the sample, and its share of toxic ones so
#: many standard errors away from that of the sample.
LEAST_TEXTS = 4
LEAST_ERRORS = 5.5
PREFIXES = (4, 5, 6, 7)
FORMS = {
    "#shout": re.compile(r"[A-Z]{3,}!{2,}"),
    "#you": re.compile(r"\byou(?:'re| are) (?:a |an |such )", re.I),
    "#hate": re.compile(r"\bhate\w*\b", re.I),
    "#masked": re.compile(r"\b\w+[*#$@]{2,}\w+\b"),
}


def features(text: str) -> set[bytes]:
    """Words, beginnings of longer words (marked by a star) and forms of a text."""
    words = set(text.lower().encode("utf-8", "surrogatepass").translate(FOLD).split())
    out = set(words)
    for k in PREFIXES:
        out.update([w[:k] + b"*" for w in words if len(w) > k])
    out.update(name.encode() for name, form in FORMS.items() if form.search(text))
    return out


def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of four words in a row, which most near copies share."""
    schema = pa.schema(
        [("sketch", pa.int64()), ("doc_id", pa.int64()), ("toxic", pa.int32()), ("text", pa.string())]
    )
    for batch in slices(batches):
        hashes = [shingle_hashes(t, 4, 1).view(np.int64) for t in batch.column("text").to_pylist()]
        least = [int(h.min()) if len(h) else 0 for h in hashes]
        yield batch_of(schema, least, *[batch.column(c) for c in ("doc_id", "toxic", "text")])


def count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with each feature by label; at most ``sample`` texts of each label come here."""
    schema = pa.schema([("feature", pa.binary()), ("toxic", pa.int32()), ("n", pa.int64())])
    counts: Counter = Counter()
    for batch in slices(batches):
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts.update((f, toxic) for f in features(text))
    if counts:
        keys = list(counts)
        yield batch_of(schema, [k[0] for k in keys], [k[1] for k in keys], list(counts.values()))


def present(wanted: dict[bytes, int]):
    schema = pa.schema([("toxic", pa.int32()), ("found", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                sorted(wanted[f] for f in features(t) if f in wanted)
                for t in batch.column("text").to_pylist()
            ]
            yield batch_of(schema, batch.column("toxic"), found)

    return run


# ------------------------------------------------------------------ the models


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Posterior chance of toxic for each row of votes (0 or 1), from ``start`` on.

    Abstaining says nothing; that all abstain is a vote of its own.
    """
    votes = np.column_stack([votes, votes.sum(1) == 0]).astype(float)
    chance = start.astype(float)
    weight = np.ones(votes.shape[1])
    for r in range(rounds):
        prior = np.clip(chance.mean(), 1e-3, 1 - 1e-3)
        on = (chance @ votes + 0.05) / (chance.sum() + 1)
        off = ((1 - chance) @ votes + 0.05) / ((1 - chance).sum() + 1)
        if r == 0:
            weight = 1 / dependence(votes, chance, on, off)
        odds = np.log(prior) - np.log1p(-prior) + votes @ (weight * (np.log(on) - np.log(off)))
        chance = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return chance


def dependence(votes: np.ndarray, chance: np.ndarray, on: np.ndarray, off: np.ndarray) -> np.ndarray:
    """With how many voters each goes along inside the classes; itself counts as one."""
    rest = np.sqrt(chance)[:, None] * (votes - on) + np.sqrt(1 - chance)[:, None] * (votes - off)
    spread = np.sqrt((rest**2).sum(0)) + 1e-9
    together = (rest.T @ rest) / spread[:, None] / spread[None, :]
    np.fill_diagonal(together, 1.0)
    return np.where(together > 0.5, together, 0).sum(1)


def linear_classifier(found: list[list[int]], target: np.ndarray, n: int, rounds: int = 400) -> np.ndarray:
    """Logistic weights and, last, the bias; both classes weigh the same; gradient descent with decay."""
    weights = np.zeros(n + 1)
    flat = np.array([f for x in found for f in x], np.int64)
    row = np.repeat(np.arange(len(found)), [len(x) for x in found])
    mass = np.where(target > 0.5, 0.5 / max(1e-9, (target > 0.5).sum()), 0.5 / max(1e-9, (target <= 0.5).sum()))
    speed = np.zeros(n + 1)
    for _ in range(rounds):
        z = weights[-1] + np.bincount(row, weights[flat], len(found))
        wrong = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) * mass
        slope = np.concatenate([np.bincount(flat, wrong[row], n), [wrong.sum()]])
        slope[:-1] += 1e-4 * weights[:-1]
        speed = 0.8 * speed - 2.0 * slope
        speed = np.clip(speed, -2, 2)
        weights = weights + speed
    return weights


class Scorer:
    """Chance of toxic from the weights; 0 where nothing could be learned."""

    def __init__(self, weights: dict[bytes, float], bias: float | None):
        self.bias = bias
        self.beginnings = {k[:-1]: w for k, w in weights.items() if k.endswith(b"*")}
        self.whole = {k: w for k, w in weights.items() if not k.endswith(b"*")}
        self.forms = [(f, weights[n.encode()]) for n, f in FORMS.items() if n.encode() in weights]

    def score(self, text: str | None) -> float:
        if self.bias is None:
            return 0.0
        text = text or ""
        words = set(text.lower().encode("utf-8", "surrogatepass").translate(FOLD).split())
        z = self.bias + sum(self.whole[w] for w in sorted(words & self.whole.keys()))
        seen = set()
        for k in PREFIXES:
            seen |= {w[:k] for w in words if len(w) > k} & self.beginnings.keys()
        z += sum(self.beginnings[s] for s in sorted(seen))
        z += sum(w for form, w in self.forms if form.search(text))
        return float(1 / (1 + np.exp(-max(-30.0, min(30.0, z)))))


def learn(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, label_col: str, sample: int):
    """(weight of each feature, bias) from labelled rows; no bias where there is nothing to learn."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    known = labels.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")
    ).where(F.col("toxic").isin(0, 1) & training)
    rank = F.xxhash64("doc_id")
    # ids alone are ranked and joined, texts only of the chosen
    few = None
    for value in (0, 1):
        one = known.where(F.col("toxic") == value).orderBy(rank, "doc_id").limit(sample)
        few = one if few is None else few.union(one)
    chosen = few.collect()  # bounded by ``sample`` ids of each label
    if len({r.toxic for r in chosen}) < 2:
        return {}, None
    few = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, toxic int")
    texts = rows.where(F.col("text").isNotNull()).join(F.broadcast(few), "doc_id")
    # near copies of one text would make all its words look telling
    texts = texts.mapInArrow(sketch, "sketch bigint, doc_id bigint, toxic int, text string")
    texts = texts.groupBy("sketch", "toxic").agg(F.min_by("text", F.struct("doc_id", "text")).alias("text"))
    texts = stage(texts, "toxicity")
    counted = texts.select("text", "toxic").mapInArrow(
        count_features, "feature binary, toxic int, n bigint"
    )
    total = Counter({r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()})
    if len(total) < 2:
        return {}, None
    counted = counted.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )
    share = total[1] / (total[0] + total[1])
    texts_with = F.col("toxic") + F.col("clean")
    errors = (F.col("toxic") - share * texts_with) / F.sqrt(texts_with * share * (1 - share))
    strong = (
        counted.where(texts_with >= LEAST_TEXTS)
        .select("feature", errors.alias("errors"))
        .where(F.abs("errors") >= LEAST_ERRORS)
        .orderBy(F.desc(F.abs("errors")), "feature")
        .limit(FEATURES)
        .collect()
    )
    place = {bytes(r.feature): i for i, r in enumerate(strong)}
    voters = [i for i, r in enumerate(strong) if r.errors > 0][:VOTERS]
    seen = texts.select("text", "toxic").mapInArrow(present(place), "toxic int, found array<int>")
    seen = seen.toArrow().to_pydict()
    if not seen["found"] or not voters:
        return {}, None
    found, toxic = seen["found"], np.array(seen["toxic"])
    votes = np.zeros((len(found), len(voters)))
    at = {v: k for k, v in enumerate(voters)}
    for i, x in enumerate(found):
        votes[i, [at[f] for f in x if f in at]] = 1
    posterior = label_model(votes, 0.1 + 0.8 * toxic)
    weights = linear_classifier(found, posterior, len(place))
    return {f: float(weights[i]) for f, i in place.items()}, float(weights[-1])


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: doc_id, score.  ``training`` is a condition on the ids of ``labels``."""
    learned = learn(docs, labels, training, id_col, text_col, label_col, sample)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*learned).score
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            yield batch_of(schema, batch.column("doc_id"), [score(t) for t in texts])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id bigint, score double")


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    training: Column,
    threshold: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    learned = learn(docs, labels, training, id_col, text_col, label_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = Scorer(*learned).score
        for batch in slices(batches, text_col):
            keep = [score(t) < threshold for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
