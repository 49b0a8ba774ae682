"""Language-model scores from Brown classes: exchange clustering and class bigrams.

Every word of the training part has one of ``classes`` classes.  The ``clustered`` most
frequent words settle them by exchange: starting from classes by rank, in each round a
third of the words may move to the class that raises the likelihood of the class bigrams
most, evaluated on the executors with the words' contexts dealt by word, and a round
that lowers the likelihood ends it.  Then every other word, however rare, is placed: with
the classes around all its occurrences, in the class whose counts raise the likelihood
most per occurrence (words without a class yet are one class more there).  Class bigrams
are counted again over the classes of all words.  A token's probability is that of its
class after the class before it, smoothed towards the class's own frequency, times that
of the word in its class, half a count added to each word and to one unknown word.  Words
that training did not have stand in the class of the most words.

Counts and classes of the ``frequent`` most frequent words go to every task (a table of
bounded size); those of all other words are joined, one row per occurrence, so the
vocabulary has no limit.

The base score is the unigram one with half a count added.  Null texts are empty
and have the end token alone; a text of spaces too.  Rows with null or repeated
ids are documents of their own; extra columns are left out; an empty table gives
no rows, and without training documents all counts are zero.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, slices, stage

FREQUENT = 1 << 17
CLUSTERED = 1 << 12
CLASSES = 64
ROUNDS = 9
#: Weight, in tokens, of a class's own frequency in its probability after another class.
BACKOFF = 20.0
#: Distinct words or bigrams that a task holds before it passes their counts on.
HELD = 300_000

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
END = b""


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, then the end token."""
    return [*text.encode("utf-8", "surrogatepass").translate(LOWER).split(), END]


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    counts: Counter = Counter()
    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            counts.update(tokens(text))
        if len(counts) > HELD:
            yield batch_of(schema, list(counts), list(counts.values()))
            counts = Counter()
    if counts:
        yield batch_of(schema, list(counts), list(counts.values()))


def count_bigrams(number: dict[bytes, int], other: int):
    """Counts of (word before, word) among clustered words, ``other`` for the rest."""
    schema = pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])

    def rows(pairs: list[np.ndarray]):
        keys, n = np.unique(np.concatenate(pairs), return_counts=True)
        return keys, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, start = number.get, number.get(END, other)
        keys, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in slices(batches):
            pairs = []
            for text in batch.column("text").to_pylist():
                ids = [get(w, other) for w in tokens(text)]
                ids = np.array([start, *ids], np.int64)
                pairs.append(ids[:-1] << 32 | ids[1:])
            new, m = rows(pairs)
            every = np.concatenate([keys, new])
            keys, at = np.unique(every, return_inverse=True)
            n = np.bincount(at, np.concatenate([n, m]), len(keys)).astype(np.int64)
            if len(keys) > 4 * HELD:
                yield batch_of(schema, (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), n)
                keys, n = keys[:0], n[:0]
        if len(keys):
            yield batch_of(schema, (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), n)

    return run


def most_frequent(vocabulary: DataFrame, most: int) -> dict[bytes, int]:
    """At most ``most`` words and their counts, frequent ones first.

    Counts are sorted into steps of about two percent, a few thousand for any corpus;
    the words above the step at which they would become too many are fetched.
    """
    step = F.floor(F.log("n") * 50).cast("int")
    sizes = vocabulary.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    taken, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["step"]):
        if taken + r["words"] > most:
            break
        taken, least = taken + r["words"], r["step"]
    if least is None:
        return {}
    rows = vocabulary.where(step >= least).collect()
    return {bytes(r.word): r.n for r in sorted(rows, key=lambda r: (-r.n, bytes(r.word)))}


# ------------------------------------------------------------------ clustering


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.where(x > 0, x, 1.0))


def class_gains(
    after: np.ndarray, before: np.ndarray, itself: float, own: int, pairs: np.ndarray, size: np.ndarray, total: float
) -> np.ndarray:
    """What the likelihood gains when a word goes from its class to each class, itself 0.

    ``after`` and ``before``: how often each class follows and precedes the word,
    other than the word itself; ``itself``: how often it follows itself.
    """
    pairs, size = pairs.copy(), size.copy()
    pairs[own] -= after
    pairs[:, own] -= before
    pairs[own, own] -= itself
    size[own] -= total
    k = np.arange(len(size))
    rows = xlogx(pairs + after[None, :]) - xlogx(pairs)
    cols = xlogx(pairs + before[:, None]) - xlogx(pairs)
    diagonal = pairs[k, k]
    gain = rows.sum(1) - rows[k, k] + cols.sum(0) - cols[k, k]
    gain += xlogx(diagonal + after + before + itself) - xlogx(diagonal)
    gain -= 2 * (xlogx(size + total) - xlogx(size))
    return gain - gain[own]


def best_moves(classes: np.ndarray, pairs: np.ndarray, size: np.ndarray, turn: int, fixed: int):
    """For rows (word, side, other, n) sorted by word: the best class and its gain."""
    schema = pa.schema([("word", pa.int32()), ("to", pa.int32()), ("gain", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def moves(word, side, other, n):
            edges = np.nonzero(np.concatenate([[True], word[1:] != word[:-1], [True]]))[0]
            out = []
            for a, b in zip(edges, edges[1:]):
                w = int(word[a])
                if w == fixed or w % 3 != turn:
                    continue
                s, o, m = side[a:b], other[a:b], n[a:b].astype(float)
                me = o == w
                itself = float(m[me & (s == 0)].sum())
                vectors = [
                    np.bincount(classes[o[~me & (s == k)]], m[~me & (s == k)], len(size))
                    for k in (0, 1)
                ]
                total = float(vectors[1].sum() + itself)
                gain = class_gains(*vectors, itself, int(classes[w]), pairs, size, total)
                gain[-1] = -1.0  # the class of all other words takes none in
                to = int(np.argmax(gain))
                if gain[to] > 1e-6:
                    out.append((w, to, float(gain[to])))
            return out

        def close(columns):
            out = moves(*columns)
            return [batch_of(schema, *zip(*out))] if out else []

        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in ("word", "side", "other", "n")]
            if held is not None:
                columns = [np.concatenate(c) for c in zip(held, columns)]
            if not len(columns[0]):
                continue
            cut = int(np.searchsorted(columns[0], columns[0][-1], "left"))
            if cut:
                yield from close([c[:cut] for c in columns])
            held = [c[cut:] for c in columns]
        if held is not None and len(held[0]):
            yield from close(held)

    return run


def class_pairs(bigrams: DataFrame, classes: np.ndarray, k: int) -> np.ndarray:
    """Counts of class bigrams; tasks send k * k sums at most."""
    schema = pa.schema([("at", pa.int32()), ("n", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k * k)
        for b in batches:
            at = classes[b.column("a").to_numpy()] * k + classes[b.column("b").to_numpy()]
            sums += np.bincount(at, b.column("n").to_numpy(), k * k)
        seen = np.nonzero(sums)[0]
        yield batch_of(schema, seen.astype(np.int32), sums[seen])

    out = np.zeros(k * k)
    sums = bigrams.mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n"))
    for row in sums.collect():
        out[row["at"]] = row["n"]
    return out.reshape(k, k)


def likelihood(pairs: np.ndarray) -> float:
    return float(xlogx(pairs).sum() - xlogx(pairs.sum(0)).sum() - xlogx(pairs.sum(1)).sum())


def exchange(bigrams: DataFrame, words: int, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Class of each clustered word (word ``words`` stands for all others), and the class bigrams."""
    k = classes + 1
    of = np.array([w % classes for w in range(words)] + [classes], np.int64)
    spark = bigrams.sparkSession
    contexts = bigrams.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("word"), F.lit(0).alias("side"), F.col("b").alias("other"), "n"),
                F.struct(F.col("b").alias("word"), F.lit(1).alias("side"), F.col("a").alias("other"), "n"),
            )
        ).alias("x")
    ).select("x.*")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    contexts = stage(contexts.repartition(n, "word").sortWithinPartitions("word"), "contexts")
    # a file that is split between tasks would split a word, hence this order within each
    pairs = class_pairs(bigrams, of, k)
    best = (likelihood(pairs), of, pairs)
    for r in range(rounds):
        step = best_moves(of, pairs, pairs.sum(0), r % 3, words)
        dealt = contexts.repartition(n, "word").sortWithinPartitions("word")
        moves = dealt.mapInArrow(step, "word int, to int, gain double").collect()
        of = of.copy()
        for m in moves:  # at most one row per clustered word
            of[m["word"]] = m["to"]
        pairs = class_pairs(bigrams, of, k)
        now = likelihood(pairs)
        if now > best[0]:
            best = (now, of, pairs)
        elif moves:
            break
    return best[1], best[2]


# ------------------------------------------------------------------ all other words


def code_type(classes: int) -> np.dtype:
    """Classes of tokens are held in as few bytes as ``classes`` + 1 numbers need."""
    return np.dtype(np.uint8 if classes < 255 else np.uint16)


def contexts(class_of: dict[bytes, int], classes: int):
    """Words outside ``class_of`` with the classes before and after each occurrence.

    A word without a class counts as class ``classes``; before the first is the end token.
    """
    schema = pa.schema([("word", pa.binary()), ("codes", pa.binary())])
    kind = code_type(classes)
    pair = 2 * kind.itemsize

    def rows(held):
        return batch_of(schema, list(held), [bytes(codes) for codes in held.values()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, start, held = class_of.get, class_of.get(END, classes), {}
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                words = tokens(text)
                of = np.array([start, *[get(w, classes) for w in words], start], kind)
                around = np.stack([of[:-2], of[2:]], 1).tobytes()
                for i in np.nonzero(of[1:-1] == classes)[0].tolist():
                    codes = held.get(words[i])
                    if codes is None:
                        held[words[i]] = bytearray(around[i * pair : i * pair + pair])
                    else:
                        codes += around[i * pair : i * pair + pair]
            if len(held) > HELD:
                yield rows(held)
                held = {}
        if held:
            yield rows(held)

    return run


def context_classes(before: np.ndarray, after: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Class of each word by how often each class stands before and after it.

    The class of the largest first-order gain: how much the likelihood of the class bigrams
    rises by the word's counts where they are small beside the class's own.
    """
    k = len(pairs) - 1
    pairs = pairs + 0.5
    size = (pairs.sum(0) + pairs.sum(1))[:k] / 2
    gain = before @ np.log(pairs[:, :k]) + after @ np.log(pairs[:k].T)
    return np.argmax(gain - 2 * before.sum(1, keepdims=True) * np.log(size), 1)


def place_words(pairs: np.ndarray):
    """Rows (word, codes) sorted by word: one row per word with its count and class."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64()), ("class", pa.int32())])
    k = len(pairs) - 1
    kind, most, long = code_type(k), 4096, 1 << 22

    def close(words, codes):
        n = np.array([len(c) for c in codes]) // (2 * kind.itemsize)
        around = np.frombuffer(b"".join(codes), kind).reshape(-1, 2)
        at = np.repeat(np.arange(len(words)) * (k + 1), n)
        sides = [np.bincount(at + around[:, i], minlength=len(words) * (k + 1)) for i in (0, 1)]
        found = context_classes(*[x.reshape(len(words), k + 1).astype(float) for x in sides], pairs)
        return batch_of(schema, words, n.astype(np.int64), found.astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, codes, own, size = [], [], [], 0
        for batch in batches:
            for word, c in zip(batch.column("word").to_pylist(), batch.column("codes").to_pylist()):
                if words and words[-1] == word:
                    own.append(c)
                else:
                    if words:
                        codes.append(b"".join(own))
                        if len(words) >= most or size > long:
                            yield close(words, codes)
                            words, codes, size = [], [], 0
                    words.append(word)
                    own = [c]
                size += len(c)
        if words:
            codes.append(b"".join(own))
            yield close(words, codes)

    return run


def filled(classes: int):
    """Rows with the classes of all tokens: those of joined words go to their places."""
    kind = code_type(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for codes, places in zip(batch.column("codes").to_pylist(), batch.column("places")):
                if places.is_valid:
                    at = places.values.to_numpy(zero_copy_only=False)
                    of = np.frombuffer(codes, kind).copy()
                    of[at >> 16] = at & 0xFFFF
                    codes = of.tobytes()
                out.append(codes)
            names = [n for n in batch.schema.names if n not in ("codes", "places")]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.binary())], [*names, "codes"])

    return run


def token_pairs(rows: DataFrame, start: int, k: int) -> np.ndarray:
    """Counts of class bigrams in ``codes``; tasks send k * k sums at most."""
    schema = pa.schema([("at", pa.int32()), ("n", pa.int64())])
    kind = code_type(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k * k, np.int64)
        for batch in batches:
            for codes in batch.column("codes").to_pylist():
                of = np.frombuffer(codes, kind).astype(np.int64)
                sums += np.bincount(np.concatenate([[start], of[:-1]]) * k + of, minlength=k * k)
        seen = np.nonzero(sums)[0]
        yield batch_of(schema, seen.astype(np.int32), sums[seen])

    out = np.zeros(k * k)
    for row in rows.select("codes").mapInArrow(run, "at int, n bigint").groupBy("at").agg(F.sum("n").alias("n")).collect():
        out[row["at"]] = row["n"]
    return out.reshape(k, k)


# ------------------------------------------------------------------ scoring


def score_locally(count, class_of, size, distinct, open_class, base_log):
    """Scores of frequent words in their classes, the classes, and all other words by place."""
    rare = pa.list_(pa.struct([("place", pa.int32()), ("word", pa.binary())]))
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_id", pa.int64()),
            ("training", pa.bool_()),
            ("n_tokens", pa.int64()),
            ("n_known", pa.int64()),
            ("base", pa.float64()),
            ("score", pa.float64()),
            ("codes", pa.binary()),
            ("rare", rare),
        ]
    )
    kind = code_type(len(size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.log10(size + 0.5 * (distinct + 1))
        known = {
            w: (math.log10(c + 0.5) - base_log, math.log10(c + 0.5) - float(logs[class_of[w]]))
            for w, c in count.items()
        }
        get = class_of.get
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            rows = []
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "training", "text")]
            for doc_id, training, text in zip(*columns):
                words = tokens(text)
                codes = np.array([get(w, open_class) for w in words], kind).tobytes()
                score, base, seen, rest = 0.0, 0.0, 0, set()
                for w, n in Counter(words).items():
                    both = known.get(w)
                    if both is None:
                        rest.add(w)
                    else:
                        base += n * both[0]
                        score += n * both[1]
                        seen += n
                places = [{"place": i, "word": w} for i, w in enumerate(words) if w in rest] if rest else []
                rows.append((row, doc_id, training, len(words), seen, base, score, codes, places))
                row += 1
            yield batch_of(schema, *zip(*rows))

    return run


def add_steps(step: np.ndarray, start: int):
    """Rows (…, score, codes) with the scores of the class bigrams added."""
    kind = code_type(len(step))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for score, codes in zip(batch.column("score").to_pylist(), batch.column("codes").to_pylist()):
                of = np.frombuffer(codes, kind).astype(np.int64)
                scores.append(score + float(step[np.concatenate([[start], of[:-1]]), of].sum()))
            names = [n for n in batch.schema.names if n not in ("score", "codes")]
            columns = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores, pa.float64())], [*names, "score"])

    return run


def score_texts(
    docs: DataFrame,
    training: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    clustered: int = CLUSTERED,
    classes: int = CLASSES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10).

    ``training`` says of each row of ``docs`` whether the model learns from it.
    """
    if not 1 <= classes < 1 << 16:
        raise ValueError("classes must be between 1 and 65535")
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
    )
    learn = rows.where("training").select("text")
    vocabulary = stage(
        learn.mapInArrow(count_words, "word binary, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n")),
        "vocabulary",
    )
    total = vocabulary.agg(F.sum("n"), F.count("*")).first()
    train_tokens, all_words = int(total[0] or 0), int(total[1])
    count = most_frequent(vocabulary, frequent)
    least = min(count.values(), default=train_tokens + 1)
    if train_tokens and END not in count:
        count[END] = vocabulary.where(F.col("word") == F.lit(bytearray(END))).first()["n"]
    number = {w: i for i, w in enumerate(list(count)[:clustered])}
    if END in count and END not in number:
        number[END] = len(number)

    bigrams = learn.mapInArrow(count_bigrams(number, len(number)), "a int, b int, n bigint")
    bigrams = stage(bigrams.groupBy("a", "b").agg(F.sum("n").alias("n")), "bigrams")
    of, pairs = exchange(bigrams, len(number), classes, rounds)
    class_of = {w: int(of[i]) for w, i in number.items()}

    # a word outside the clustered ones has a bounded share of the tokens, and so has its task
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = learn.mapInArrow(contexts(class_of, classes), "word binary, codes binary")
    found = found.repartition(n, "word").sortWithinPartitions("word")
    placed = stage(found.mapInArrow(place_words(pairs), "word binary, n bigint, class int"), "placed")
    size, distinct = np.zeros(classes), np.zeros(classes)
    for w, i in class_of.items():
        size[i] += count[w]
        distinct[i] += 1
    for r in placed.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        size[r["class"]] += r["n"]
        distinct[r["class"]] += r["words"]
    for r in placed.where(F.col("n") >= least).select("word", "class").collect():
        class_of[bytes(r["word"])] = r["class"]
    open_class = int(np.argmax(distinct))
    start = class_of.get(END, open_class)
    base_log = math.log10(train_tokens + 0.5 * (all_words + 1))

    schema = (
        "row bigint, doc_id bigint, training boolean, n_tokens bigint, n_known bigint, base double, "
        "score double, codes binary, rare array<struct<place:int,word:binary>>"
    )
    # bounded by ``frequent`` words
    shared = spark.sparkContext.broadcast((count, class_of, size, distinct, open_class, base_log))

    def score(batches):
        return score_locally(*shared.value)(batches)

    local = stage(rows.select("doc_id", "training", "text").mapInArrow(score, schema), "scores")
    rare = local.select("row", F.explode("rare").alias("x")).select("row", "x.place", "x.word")
    logs = F.array(*[F.lit(float(x)) for x in np.log10(size + 0.5 * (distinct + 1))])
    own = F.coalesce(F.col("class"), F.lit(open_class))
    c = F.coalesce(F.col("n"), F.lit(0))
    rare = rare.join(placed, "word", "left").select(
        "row",
        (c > 0).cast("long").alias("known"),
        (F.log10(c + 0.5) - base_log).alias("base"),
        (F.log10(c + 0.5) - F.get(logs, own)).alias("score"),
        (F.shiftleft(F.col("place").cast("long"), 16) + own).alias("place"),
    )
    rare = rare.groupBy("row").agg(
        F.sum("known").alias("known_"), F.sum("base").alias("base_"), F.sum("score").alias("score_"),
        F.collect_list("place").alias("places"),
    )
    zero = F.lit(0)
    whole = local.drop("rare").join(rare, "row", "left").select(
        "doc_id",
        "training",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_", zero)).alias("n_known"),
        (F.col("base") + F.coalesce("base_", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("score_", zero)).alias("score"),
        "codes",
        "places",
    )
    kept = "doc_id bigint, training boolean, n_tokens bigint, n_known bigint, base_score double, "
    whole = stage(whole.mapInArrow(filled(classes), kept + "score double, codes binary"), "classes")

    pairs = token_pairs(whole.where("training"), start, classes)
    share = pairs.sum(0) + 0.5
    share /= share.sum()
    step = np.log10((pairs + BACKOFF * share[None, :]) / (pairs.sum(1, keepdims=True) + BACKOFF))
    scored = whole.mapInArrow(add_steps(step, start), kept + "score double")
    return scored.select(
        "doc_id", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
