"""Near copies by the similarity of their sets of shingles: SimHash, then MinHash, exact check.

A text is the set of its runs of ``width`` words (of all words if there are fewer), as
64-bit hashes; two texts are near copies if their sets have a Jaccard similarity of
``similarity`` or more.  Equal sets are one node, whatever the number of documents.

Two rounds propose candidates, and every candidate is checked exactly.  First come those
whose SimHash fingerprints are linked at DISTANCE bits or fewer by the range join of
``simhash.py`` on segment popcounts: a component of fingerprints is a bucket.  At a
similarity of 0.8 fingerprints differ in about ten bits, more than that join can afford,
so a second round finds what is not joined yet: its candidates share one of BANDS keys
made of ROWS minima each, by which a pair at 0.8 is missed once in 300,000 pairs and
closer ones less often.

A bucket gives no pairs of all its members.  Each is first checked against the smallest
one, unless a round before has joined them; buckets whose other members are not in one
component after that are compared in full inside tasks, in pairs of salted parts if they
are large.  Buckets with the same members count once.  Only texts that have a candidate
send their sets.

Null and empty texts, and texts of spaces, have the empty set and are copies of each
other.  Of a component the row with the smallest id stays, the first of those as they
are read; null ids come last.  Rows with repeated ids are rows of their own.  A text of any
length is read whole.  All columns of the input stay, whatever their names; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm import simhash
from topicflow.llm.common import batch_of, numbered, slices, stage
from topicflow.llm.components import components
from topicflow.llm.simhash import Joined, fingerprint, shingle_hashes

WIDTH = 5
SIMILARITY = 0.8
SEED = 42
#: Differing bits of fingerprints; the range join does the same work for 4 as for 5.
DISTANCE = 5
BANDS, ROWS = 32, 5
#: Members of a bucket that a task holds at most twice over.
PART_ROWS = 1 << 9

_RANDOM = np.random.default_rng(20240229)
MASKS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64)
FACTORS = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes."""
    return np.unique(shingle_hashes(text, width, SEED))


def set_id(shingles: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """BANDS keys; two sets share each with the chance of their similarity to the power ROWS."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 1024):
        mixed = (shingles[None, k : k + 1024] ^ MASKS) * FACTORS
        least = np.minimum(least, mixed.min(1))
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * MIX
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def sketch(width: int):
    schema = pa.schema(
        [
            ("row", pa.int64()),
            ("doc_id", pa.int64()),
            ("set", pa.int64()),
            ("fp", pa.int64()),
            ("bands", pa.list_(pa.int64())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t or "", width) for t in batch.column("text").to_pylist()]
            ids, fps, bands = ([f(s) for s in sets] for f in (set_id, fingerprint, band_keys))
            yield batch_of(schema, batch.column("row"), batch.column("doc_id"), ids, fps, bands)

    return run


def shingle_sets(width: int):
    schema = pa.schema([("set", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t or "", width).view(np.int64) for t in batch.column("text").to_pylist()]
            yield batch_of(schema, batch.column("set"), sets)

    return run


def bucket_links(ids: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], similarity: float):
    """Links (a, b) inside one bucket between members that are not yet in one component."""
    sizes = np.array([len(s) for s in sets])
    begins = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(sets)
    group = np.unique(roots, return_inverse=True)[1]
    for i, own in enumerate(sets):
        later = np.nonzero(group[i + 1 :] != group[i])[0] + i + 1
        most = np.maximum(sizes[later], len(own))
        later = later[np.minimum(sizes[later], len(own)) / most >= similarity]
        if not len(later):
            continue
        # the others are read in runs of a bounded size
        for part in np.array_split(later, -(-int(sizes[later].sum()) // (1 << 21))):
            theirs = np.concatenate([flat[begins[j] : begins[j + 1]] for j in part])
            at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            edges = np.concatenate([[0], np.cumsum(sizes[part])[:-1]])
            common = np.add.reduceat((own[at] == theirs).astype(np.int64), edges)
            near = part[common / (sizes[part] + len(own) - common) >= similarity]
            for j in near:
                if group[j] != group[i]:
                    group[group == group[j]] = group[i]
                    yield int(ids[i]), int(ids[j])


def compare_buckets(similarity: float):
    """Rows (cell, set, root, shingles) sorted by cell to links (a, b)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = Joined()
        cell, ids, roots, sets = None, [], [], []

        def close():
            links = list(bucket_links(np.array(ids), np.array(roots), sets, similarity))
            links = joined.fresh(*zip(*links)) if links else []
            return [batch_of(schema, *zip(*links))] if links else []

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("cell", "set", "root")]
            for c, s, r, shingles in zip(*columns, batch.column("shingles")):
                if c != cell and ids:
                    yield from close()
                    ids, roots, sets = [], [], []
                cell = c
                ids.append(s)
                roots.append(r)
                # sorted as unsigned numbers, as bits of signed ones
                sets.append(shingles.values.to_numpy(zero_copy_only=False).view(np.uint64).copy())
        if ids:
            yield from close()

    return run


def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.select(F.col("node").alias("set"), "root")
    return rows.join(named, "set", "left").withColumn("root", F.coalesce("root", "set"))


def fingerprint_keys(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(set, key): sets share a key if links of ``distance`` bits or fewer join their fingerprints.

    ``classes``: (set, fp).  The links are those of the range join on segment popcounts.
    """
    fps = stage(classes.select("fp").distinct(), "fingerprints")
    roots = components(simhash.near_links(fps, distance)).withColumnRenamed("node", "fp")
    return classes.join(roots, "fp", "left").select("set", F.coalesce("root", "fp").alias("key"))


def buckets_of(keyed: DataFrame) -> DataFrame:
    """(set, key) to (key, n, center, set) of keys with several sets, those with the same ones once."""
    keys = keyed.groupBy("key").agg(
        F.count("*").alias("n"),
        F.min("set").alias("center"),
        F.max("set").alias("last"),
        F.bit_xor(F.xxhash64("set")).alias("members"),
    )
    keys = keys.where("n > 1").groupBy("n", "center", "last", "members").agg(F.min("key").alias("key"))
    return stage(keyed.join(keys, "key").select("key", "n", "center", "set"), "buckets")


def near_links(
    classes: DataFrame,
    texts: DataFrame,
    width: int,
    similarity: float,
    part_rows: int = PART_ROWS,
    prints: DataFrame | None = None,
) -> DataFrame:
    """Links (a, b) that connect sets exactly as all checked candidates would.

    ``classes``: (set, at, bands), ``at`` being a row of ``texts`` (row, text) that has the set.
    ``prints``: (set, key), as ``fingerprint_keys`` gives them; their round comes first.
    """
    rounds = [] if prints is None else [buckets_of(prints)]
    rounds.append(buckets_of(classes.select("set", F.explode("bands").alias("key"))))
    wanted = reduce(DataFrame.unionAll, [buckets.select("set") for buckets in rounds]).distinct()
    named = classes.select("set", F.col("at").alias("row")).join(wanted, "set")
    sets = texts.join(named, "row").select("set", "text")
    sets = stage(sets.mapInArrow(shingle_sets(width), "set bigint, shingles array<bigint>"), "sets")
    links = None
    for buckets in rounds:
        links = checked_links(buckets, sets, similarity, part_rows, links)
    return links


def checked_links(
    buckets: DataFrame, sets: DataFrame, similarity: float, part_rows: int, known: DataFrame | None = None
) -> DataFrame:
    """``known`` links and those that connect the members of each bucket as all its pairs would."""
    pairs = buckets.where("set != center").select(F.col("center").alias("a"), F.col("set").alias("b")).distinct()
    if known is not None:
        roots = stage(components(known), "links")
        ends = [roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab"]
        pairs = pairs.join(ends[0], "a", "left").join(ends[1], "b", "left")
        # without a root a set stands alone
        pairs = pairs.where("coalesce(root_a, a) != coalesce(root_b, b)").select("a", "b")
    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    near = common / (F.size("x") + F.size("y") - common) >= F.lit(similarity)
    links = pairs.join(left, "a").join(right, "b").where(near).select("a", "b")
    links = stage(links if known is None else known.unionByName(links), "links")

    rest = with_roots(buckets.where("n > 2 AND set != center"), stage(components(links), "links"))
    open_ = rest.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    rest = stage(rest.join(open_.where("least != most").select("key"), "key"), "buckets")
    count = F.ceil(F.col("n") / part_rows * 2).cast("int")
    parts = F.when(F.col("n") > part_rows, count).otherwise(1)
    own = F.pmod(F.xxhash64("set"), parts).cast("int")
    # a member of a large bucket goes to every pair of parts that holds its own
    dealt = F.transform(
        F.sequence(F.lit(0), parts - 1), lambda o: F.least(own, o) * parts + F.greatest(own, o)
    )
    cells = rest.select("key", "set", "root", F.explode(dealt).alias("part"))
    cells = cells.select(F.xxhash64("key", "part").alias("cell"), "set", "root").join(sets, "set")
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.select("cell", "set", "root", "shingles").repartition(n, "cell").sortWithinPartitions("cell")
    more = cells.mapInArrow(compare_buckets(similarity), "a bigint, b bigint")
    return stage(links.unionByName(more), "links")


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, row = numbered(docs, "near-copies")
    texts = rows.select(F.col(row).alias("row"), F.col(text_col).cast("string").alias("text"))
    found = rows.select(
        F.col(row).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(sketch(width), "row bigint, doc_id bigint, set bigint, fp bigint, bands array<bigint>")
    found = stage(found, "sketches")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    least = [F.min(place).alias("least"), F.min("fp").alias("fp"), F.min("bands").alias("bands")]
    classes = found.groupBy("set").agg(*least)
    classes = stage(classes.withColumn("at", F.col("least.row")), "sketches")
    prints = fingerprint_keys(classes.select("set", "fp"))
    roots = components(near_links(classes, texts, width, similarity, prints=prints))
    placed = with_roots(classes.select("set", "least"), roots)
    first = placed.groupBy("root").agg(F.min("least").alias("first"))
    stays = placed.join(first, "root").select("set", F.col("first.row").alias("stays"))
    gone = found.select("row", "set").join(stays, "set").where("row != stays").select(F.col("row").alias(row))
    return rows.join(stage(gone, "gone"), row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
