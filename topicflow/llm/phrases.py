"""Phrases that occur often and hold together, per language, mined as Toivonen does.

A sample proposes the phrases that look frequent, at a lowered threshold.  A pass over all
documents then counts these and their negative border exactly: every phrase whose parts
without the last and without the first word were proposed, and every single word.  Border
phrases that turn out frequent are failures of the proposal; they join it, and an expansion pass counts the border
that this adds.  That pass takes what it meets for the first time as proposed too, so it
follows the border as far as it can reach and closes it: each phrase of frequent parts is
then counted.  A phrase is counted whole in the one pass where it first belongs, so all
counts are exact, and since no phrase is more frequent than its parts, none is missed.

Most border phrases are rare, and counting each by its words would move more than the
texts.  Before the full pass every phrase it would count is therefore added up by a bucket of
its hash, as Park, Chen and Yu do; a phrase is no more frequent than its bucket, so the
full pass counts those of buckets that reach the threshold, and no other can be frequent.

Tasks know the proposal through a filter of hash bits, whose size follows the number of
proposed phrases up to a bound.  A false hit only makes a pass count a phrase in vain, so
the filter may fill up without changing the result.  Counts are kept by the words
themselves, not by hashes.  Everything per language goes through (language, phrase), so a
frequent language is spread by its phrases, and partial counts are added before they move.

Text: A-Z to lower case, cut into pieces at ``. , ; : ! ?`` and U+000A to U+000D, pieces cut
into words at spaces and tabs; phrases lie within a piece.  A null language counts as
``und``; a null text has no words.  Texts of any length are read in chunks.  Rows with null or
repeated ids are rows of their own.  Ties go to the phrase first in byte order.  Extra
columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, give_back, slices, stage

#: Share of the rows that is in the sample.
SAMPLE = 1 / 16
CHUNK_BYTES = 2 << 20
HELD_BYTES = 6 << 20
ROWS = 1 << 16
BATCH_ROWS = 500
#: Bits of the filter per proposed phrase, and the bounds of their number as powers of two.
BITS_PER_PHRASE = 16
FEWEST_BITS, MOST_BITS = 16, 28
#: Ranges of buckets that are added up by themselves, as a power of two.
RANGES = 8
UNKNOWN = "und"
END = 0xFF  # no byte of UTF-8, stands between pieces

TABLE = bytes(
    b + 32 if 65 <= b <= 90 else END if b in b".,;:!?" or 10 <= b <= 13 else b for b in range(256)
)
GAP = re.compile(rb"[ \t\xff]")


def words_of(texts: Iterable[str]) -> bytes:
    """Lower-cased texts with END between pieces."""
    return "\n".join(texts).encode("utf-8", "surrogatepass").translate(TABLE)


def chunks(data: bytes, context: int) -> Iterator[tuple[list[bytes], int]]:
    """(words and ENDs, how many of them are only there as the context of the next)."""
    at, before = 0, []
    while at < len(data):
        gap = GAP.search(data, at + CHUNK_BYTES)
        to = gap.start() if gap else len(data)
        new = data[at:to].replace(b"\xff", b" \xff ").split()
        yield before + new, len(before)
        before, at = (before + new)[-context:] if context else [], to


def mixed(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from the hashes of all but its last word and of that word."""
    h = before * np.uint64(0x9E3779B97F4A7C15) + (word ^ np.uint64(0xD6E8FEB86659FD93))
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def word_hashes(words: Iterable[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def phrase_hash(words: list[bytes], lang: str) -> np.uint64:
    hashes = word_hashes(words, lang)
    out = hashes[:1]
    for k in range(1, len(hashes)):
        out = mixed(out, hashes[k : k + 1])
    return out[0]


@dataclass(frozen=True)
class Filter:
    """Bits of the proposed phrases; ``everything`` lets all but single words pass."""

    bits: np.ndarray
    power: int
    everything: bool = False

    @staticmethod
    def places(hashes: np.ndarray, power: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64((1 << power) - 1)
        return hashes & mask, (hashes >> np.uint64(33)) & mask

    def has(self, hashes: np.ndarray, length: int) -> np.ndarray:
        if self.everything and length > 1:
            return np.ones(len(hashes), bool)
        found = np.ones(len(hashes), bool)
        for at in self.places(hashes, self.power):
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found


@dataclass(frozen=True)
class Buckets:
    """Bits of the buckets that reach the threshold."""

    bits: np.ndarray
    power: int

    @staticmethod
    def of(hashes: np.ndarray, power: int) -> np.ndarray:
        return (hashes * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - power)

    def hold(self, hashes: np.ndarray) -> np.ndarray:
        at = self.of(hashes, self.power)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


Rows = tuple[list[bytes], np.ndarray]
#: Hashes (None: needless), counts, and the phrases at given numbers.
Found = tuple[np.ndarray | None, np.ndarray, Callable[[np.ndarray], list[bytes]]]


def count_chunk(
    words: list[bytes],
    seen: int,
    lang: str,
    longest: int,
    now: Filter | None,
    done: Filter | None,
    heavy: Buckets | None = None,
) -> Iterator[Rows]:
    """(phrases, counts) of a chunk, those that end in its first ``seen`` words left out.

    Without ``now`` only single words are counted; the empty phrase stands for all words.
    With ``done`` phrases whose parts that filter has, and single words, were counted before;
    all others that are met count as proposed.  With ``heavy`` only phrases of such buckets count.
    """
    for hashes, times, names in phrases_of_chunk(words, seen, lang, longest, now, done):
        there = times > 0
        if heavy is not None and hashes is not None:
            there &= heavy.hold(hashes)
        there = np.nonzero(there)[0]
        yield names(there), times[there]
    if done is None:
        yield [b""], np.array([len(words) - seen - words[seen:].count(b"\xff")])


def phrases_of_chunk(
    words: list[bytes], seen: int, lang: str, longest: int, now: Filter | None, done: Filter | None
) -> Iterator[Found]:
    """What ``count_chunk`` counts, a length at a time."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    numbers[b"\xff"]
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    names = list(numbers)
    word_hash = None if now is None else word_hashes(names, lang)
    if done is None:
        times = np.bincount(ids[seen:], minlength=len(names))
        times[0] = 0
        yield word_hash, times, lambda there: [names[i] for i in there]
    if now is None or longest < 2:
        return
    real = np.arange(len(names)) > 0
    passes = (now.has(word_hash, 1) & real)[ids]
    passed = (done.has(word_hash, 1) & real)[ids] if done is not None else None
    part, hashes = ids, word_hash  # at each place: the phrase of the last length, by number
    for length in range(2, longest + 1):
        at = np.nonzero(passes[:-1] & passes[1:])[0]
        if not len(at):
            return
        last = ids[at + length - 1]
        key = part[at] * len(names) + last
        _, first, which = np.unique(key, return_index=True, return_inverse=True)
        times = np.bincount(which, weights=at + length - 1 >= seen, minlength=len(first)).astype(np.int64)
        if passed is not None:
            before = passed[at[first]] & passed[at[first] + 1]
            times[before] = 0
        hashes = mixed(hashes[part[at[first]]], word_hash[last[first]])
        begin = at[first]
        yield hashes, times, lambda there: [b" ".join(words[i : i + length]) for i in begin[there].tolist()]
        if length == longest:
            return
        size = len(words) - length + 1
        part = np.full(size, -1)
        part[at] = which
        proposed = now.has(hashes, length)
        if passed is not None:
            passed = np.zeros(size, bool)
            passed[at] = (before & done.has(hashes, length))[which]
            proposed |= ~before
        passes = np.zeros(size, bool)
        passes[at] = proposed[which]


def held_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """(lang, texts) of about HELD_BYTES at a time."""
    held: defaultdict[str, list[str]] = defaultdict(list)
    size = 0
    for batch in slices(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            held[lang].append(text)
        size += batch.nbytes
        if size >= HELD_BYTES:
            yield from held.items()
            held.clear()
            size = 0
            give_back()
    yield from held.items()
    held.clear()
    give_back()


def packed(numbers: np.ndarray) -> bytes:
    """Small numbers as bytes, lowest ones first, compressed."""
    return pa.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), "zstd", asbytes=True)


def unpacked(raw: bytes, count: int) -> np.ndarray:
    flat = np.frombuffer(pa.decompress(raw, 4 * count, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)


def bucket_counts(longest: int, shared, at_least: int, power: int):
    """Texts to rows (range, count, gaps between buckets, counts of each), a few for every chunk."""
    schema = pa.schema([("range", pa.int32()), ("size", pa.int32()), ("gaps", pa.binary()), ("counts", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        for lang, texts in held_texts(batches):
            for words, seen in chunks(words_of(texts), longest - 1):
                places, numbers = [], []
                for hashes, times, _ in phrases_of_chunk(words, seen, lang, longest, now, None):
                    there = np.nonzero(times)[0]
                    places.append(Buckets.of(hashes[there], power).astype(np.uint32))
                    numbers.append(times[there])
                buckets, which = np.unique(np.concatenate(places), return_inverse=True)
                # more than the threshold in one place says no more than the threshold
                counts = np.minimum(np.bincount(which, np.concatenate(numbers)), at_least)
                edges = np.searchsorted(buckets, np.arange((1 << RANGES) + 1) << (power - RANGES))
                rows = []
                for r, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
                    if a < b:
                        own = buckets[a:b] - np.uint32(r << (power - RANGES))
                        rows.append((r, b - a, packed(np.diff(own, prepend=own.dtype.type(0))), packed(counts[a:b])))
                if rows:
                    yield batch_of(schema, *zip(*rows))

    return run


def full_buckets(at_least: int, power: int):
    """Rows sorted by range to (range, bits)."""
    schema = pa.schema([("range", pa.int32()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(1 << (power - RANGES), np.int64)

        def close():
            return batch_of(schema, [now], [np.packbits(total >= at_least, bitorder="little").tobytes()])

        for batch in batches:
            for r, size, gaps, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if r != now:
                    if now is not None:
                        yield close()
                    now = r
                    total[:] = 0
                total[np.cumsum(unpacked(gaps, size))] += unpacked(counts, size)
        if now is not None:
            yield close()

    return run


def heavy_buckets(docs: DataFrame, longest: int, now: Filter, at_least: int, power: int) -> Buckets:
    """The buckets whose phrases, as ``counted`` would count them, come to ``at_least``."""
    spark = docs.sparkSession
    run = bucket_counts(longest, spark.sparkContext.broadcast(now), at_least, power)
    rows = docs.mapInArrow(run, "range int, size int, gaps binary, counts binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "range").sortWithinPartitions("range")
    found = rows.mapInArrow(full_buckets(at_least, power), "range int, bits binary").toArrow()
    bits = np.zeros((1 << RANGES, 1 << (power - RANGES - 3)), np.uint8)
    for r, raw in zip(*(c.to_pylist() for c in found.columns)):
        bits[r] = np.frombuffer(raw, np.uint8)
    return Buckets(bits.ravel(), power)


def buckets_for(chars: float, at_least: int) -> int:
    """So many buckets, as a power of two, that all phrases leave them far below the threshold."""
    return min(MOST_BITS, max(FEWEST_BITS, math.ceil(math.log2(max(1, 2 * chars / at_least)))))


def counted(
    docs: DataFrame, longest: int, now: Filter | None, done: Filter | None = None, heavy: Buckets | None = None
) -> DataFrame:
    """(lang, phrase, words, n) over all rows, see ``count_chunk``."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast((now, done, heavy))
    # one column of phrase, tab and language keeps the rows that are added up small; a phrase has no tab
    schema = pa.schema([("key", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done, heavy = shared.value
        for lang, texts in held_texts(batches):
            end = b"\t" + lang.encode()
            for words, seen in chunks(words_of(texts), longest - 1):
                for phrases, times in count_chunk(words, seen, lang, longest, now, done, heavy):
                    for i in range(0, len(phrases), ROWS):
                        keys = [p + end for p in phrases[i : i + ROWS]]
                        yield batch_of(schema, pa.array(keys, pa.binary()).cast(pa.string()), times[i : i + ROWS])

    found = docs.mapInArrow(run, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("key", "\t", 1)
    size = F.when(phrase == "", 0).otherwise(F.length(phrase) - F.length(F.replace(phrase, F.lit(" "))) + 1)
    lang = F.substring("key", F.length(phrase) + 2, F.length("key"))
    return found.select(lang.alias("lang"), phrase.alias("phrase"), size.cast("int").alias("words"), "n")


def bit_words(phrases: DataFrame, power: int) -> DataFrame:
    """(word, bits): the 64-bit words of a filter that are not zero, made on the executors."""
    schema = pa.schema([("word", pa.int64()), ("bits", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column("phrase").to_pylist(), batch.column("lang").to_pylist())
            hashes = np.array([phrase_hash(p.encode().split(b" "), lang) for p, lang in texts], np.uint64)
            at = np.concatenate(Filter.places(hashes, power))
            bits = np.uint64(1) << (at & np.uint64(63))
            yield batch_of(schema, (at >> np.uint64(6)).astype(np.int64), bits.view(np.int64))

    found = phrases.select("lang", "phrase").mapInArrow(run, "word bigint, bits bigint")
    return found.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def filter_of(phrases: DataFrame, power: int, everything: bool = False) -> Filter:
    """The filter of staged phrases; the driver gets its 2^(power - 6) words at most."""
    words = np.zeros(1 << (power - 6), np.uint64)
    found = bit_words(phrases, power).toArrow()
    at = found.column("word").to_numpy()
    words[at] = found.column("bits").to_numpy().view(np.uint64)
    return Filter(words.view(np.uint8), power, everything)


def power_for(count: int) -> int:
    return min(MOST_BITS, max(FEWEST_BITS, math.ceil(math.log2(max(1, count * BITS_PER_PHRASE)))))


def lowered(at_least: int, share: float) -> int:
    """Threshold in the sample: one standard deviation below the expected count, 2 at least."""
    expected = at_least * share
    return max(2, math.ceil(expected - math.sqrt(expected)))


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_ROWS texts while the passes run; 10,000 long texts at a time take
    a hundred megabytes on both sides of a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def frequent_phrases(
    docs: DataFrame, longest: int, at_least: int, lang_col: str = "lang", text_col: str = "text",
    sample: float = SAMPLE,
) -> DataFrame:
    """(lang, phrase, words, n): every phrase of up to ``longest`` words with its exact count
    where that is ``at_least`` or more, and the count of all words under the empty phrase.

    ``sample`` is the share of rows that proposes; it matters for the number of passes only.
    """
    with short_batches(docs.sparkSession):
        return _frequent(docs, longest, at_least, lang_col, text_col, sample)


def _frequent(docs: DataFrame, longest: int, at_least: int, lang_col: str, text_col: str, sample: float) -> DataFrame:
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    ).filter(F.length("text") > 0)
    chosen = stage(rows.sample(sample, seed=7), "phrases-sample")
    threshold = lowered(at_least, sample)
    single, often = F.col("words") == 1, F.col("n") >= at_least

    # the sample: its frequent words, then all phrases of them
    words = stage(counted(chosen, 1, None).filter(single & (F.col("n") >= threshold)), "phrases-words")
    seeds = filter_of(words, power_for(words.count()), everything=True)
    deeper = counted(chosen, max(1, longest - 1), seeds).filter((F.col("words") > 0) & (F.col("n") >= threshold))
    proposed = stage(deeper.select("lang", "phrase"), "phrases-proposed")
    now = filter_of(proposed, power_for(proposed.count()))
    chars = (chosen.agg(F.sum(F.length("text"))).first()[0] or 0) / max(sample, 1e-9)
    heavy = heavy_buckets(rows, longest, now, at_least, buckets_for(chars, at_least))
    found = counted(rows, longest, now, heavy=heavy).filter(often | (F.col("words") == 0))
    found = stage(found, "phrases-counted")
    failures = found.filter(F.col("words").between(1, longest - 1)).join(proposed, ["lang", "phrase"], "left_anti")
    failures = stage(failures.select("lang", "phrase"), "phrases-failures")
    if failures.isEmpty():
        return found
    more = Filter(now.bits | filter_of(failures, now.power).bits, now.power)
    return found.unionAll(stage(counted(rows, longest, more, now).filter(often), "phrases-expanded"))


def cut_scores(frequent: DataFrame, totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase of two words or more, at its worst cut.

    All numbers are exact: products are decimals of 38 digits.
    """
    whole = frequent.filter("words > 1").select("lang", "phrase", F.col("n").alias("a"))
    word = F.split("phrase", " ")
    cut = whole.select("*", F.explode(F.sequence(F.lit(1), F.size(word) - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(word, 1, F.col("k")), " ").alias("first"),
        F.array_join(F.slice(word, F.col("k") + 1, F.size(word) - F.col("k")), " ").alias("rest"),
    )
    count = frequent.select("lang", F.col("phrase").alias("part"), F.col("n").alias("times"))
    first = count.select("lang", F.col("part").alias("first"), F.col("times").alias("l"))
    rest = count.select("lang", F.col("part").alias("rest"), F.col("times").alias("r"))
    both = cut.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    both = both.withColumn("score", F.expr(
        "cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(total as decimal(18,0))"
        " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    ))
    worst = F.min(F.struct("score", "k", "l", "r", "a", F.col("total").alias("n"))).alias("w")
    best = both.groupBy("lang", "phrase").agg(worst)
    return best.select("lang", "phrase", "w.a", "w.l", "w.r", "w.n", "w.score")


def covered(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, inside): the count of the most frequent longer phrase that holds it."""
    word = F.split("phrase", " ")
    size = F.size(word)
    parts = F.flatten(
        F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), size - n + 1), lambda i: F.array_join(F.slice(word, i, n), " ")
            ),
        )
    )
    longer = frequent.filter("words > 2").select("lang", F.explode(parts).alias("phrase"), "n")
    return longer.groupBy("lang", "phrase").agg(F.max("n").alias("inside"))


def collocations(
    docs: DataFrame, longest: int = 5, at_least: int = 100, first: int = 2000,
    lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` best phrases of each language.

    A phrase is left out if a longer one that holds it is as frequent.
    """
    frequent = stage(frequent_phrases(docs, longest, at_least, lang_col, text_col), "phrases-frequent")
    # written by itself, so that the planner knows how small it is
    totals = stage(frequent.filter("words = 0").select("lang", F.col("n").alias("total")), "phrases-totals")
    scored = cut_scores(frequent, totals).join(covered(frequent), ["lang", "phrase"], "left")
    scored = scored.filter(F.col("inside").isNull() | (F.col("inside") < F.col("a"))).drop("inside")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts of a language, so that no task sees more than the best of each part
    part = F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("part")
    some = Window.partitionBy("lang", "part").orderBy(*order)
    best = scored.select("*", part).withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= first)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return best.filter(F.col("rank") <= first).select(
        "lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"
    )
