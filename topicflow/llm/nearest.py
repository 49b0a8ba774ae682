"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Vectors are brought to unit length, where the nearest by cosine are the nearest
by Euclidean distance.  Each of ``tables`` tables has ``projections`` Gaussian
(2-stable) projections, shifted and cut into slots of ``width``; the slots of a
vector name its bucket.  A query looks at its own bucket and at perturbed ones,
some slots one up or down, in the order of the sum of squared distances from its
projections to the slots' borders, which estimates how likely they hold a near
vector.  The number of probes is fitted on a bounded sample: the fewest that find
``recall`` of the true neighbours among the sample; in the whole table neighbours
are nearer than in a sample.  More than 4,096 probes a table are never made; where the
sample wants more, recall stays below ``recall``.

Every vector is indexed.  Equal vectors are one entry with their smallest ids (as
many as can ever be among a query's neighbours).  Buckets above CHUNK entries are
dealt to several groups, each of which sees the bucket's queries.  A group ranks
its entries exactly and passes on the best few of each query; the tables'
candidates are merged by query.

Vectors that are null, empty, zero, of another length than most, or that hold null
or non-finite components take no part.  Null ids take no part either.  Repeated
ids are vectors of their own, but none is its own neighbour by id.  Ties go to the
smaller id.  Extra columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, stage

TABLES = 2
PROJECTIONS = 4
WIDTH = 1.0
SAMPLE = 2000
SAMPLE_QUERIES = 200
RECALL = 0.96
CHUNK = 20_000
TOLERANCE = 1e-9


class Hashes:
    """The projections of all tables; the same everywhere for a seed and a dimension."""

    def __init__(self, dimension: int, tables: int, projections: int, width: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.tables, self.projections, self.width = tables, projections, width
        self.vectors = rng.standard_normal((dimension, tables * projections))
        self.shift = rng.uniform(0, width, tables * projections)

    def slots(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot of each projection, (n, tables, projections), and the place within it from 0 to 1."""
        at = (unit @ self.vectors + self.shift) / self.width
        slot = np.floor(at)
        shape = (len(unit), self.tables, self.projections)
        return slot.astype(np.int64).reshape(shape), (at - slot).reshape(shape)


def bucket_of(slots: np.ndarray, table: np.ndarray | int) -> np.ndarray:
    """One number for a table and its slots; slots of unit vectors stay far below 2^10."""
    out = np.full(slots.shape[:-1], 0, np.int64) + table
    for k in range(slots.shape[-1]):
        out = out * 1021 + (slots[..., k] + 510)
    return out


def probes(place: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` perturbations of a query in one table, best first, the bucket itself first.

    A slot can go any number of steps up or down; its score is the squared
    distance from the projection to the slot's nearer border.
    """
    m = len(place)
    steps = []  # per projection its moves in order of score, no move first
    for x in place:
        moves = [(0.0, 0)] + [((k - x) ** 2, k) for k in range(1, 9)] + [((x + k - 1) ** 2, -k) for k in range(1, 9)]
        steps.append(sorted(moves))
    heap, out = [(0.0, (0,) * m)], []
    pushed = {(0,) * m}
    while heap and len(out) < count:
        score, at = heappop(heap)
        out.append([steps[k][i][1] for k, i in enumerate(at)])
        for k in range(m):
            if at[k] + 1 < len(steps[k]):
                next_ = (*at[:k], at[k] + 1, *at[k + 1 :])
                if next_ not in pushed:
                    pushed.add(next_)
                    more = steps[k][at[k] + 1][0] - steps[k][at[k]][0]
                    heappush(heap, (score + more, next_))
    return np.array(out, np.int64)


def unit_rows(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def fit_probes(sample: np.ndarray, hashes: Hashes, k: int, recall: float) -> int:
    """The fewest probes per table that find ``recall`` of the neighbours in the sample."""
    if len(sample) <= k + 1:
        return 1
    unit = unit_rows(sample)
    queries = np.arange(min(SAMPLE_QUERIES, len(sample)))
    near = unit[queries] @ unit.T
    near[queries, queries] = -2
    true = np.argsort(-near, axis=1)[:, :k]
    slots, place = hashes.slots(unit)
    most, ranks = 4096, np.full((len(queries), k, hashes.tables), 1 << 30)
    for t in range(hashes.tables):
        for q in queries:
            order = probes(place[q, t], most) + slots[q, t]
            rank = {b: i for i, b in enumerate(bucket_of(order, t).tolist())}
            own = bucket_of(slots[true[q], t], t).tolist()
            ranks[q, :, t] = [rank.get(b, 1 << 30) for b in own]
    found = np.sort(ranks.min(2).ravel())
    at = int(np.ceil(recall * len(found))) - 1
    return int(min(most, found[at] + 1))


def index_rows(hashes: Hashes):
    schema = pa.schema([("bucket", pa.int64()), ("entry", pa.int64()), ("vector", pa.binary()), ("ids", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = stacked(batch.column("vector"))
            slots, _ = hashes.slots(unit_rows(x))
            for t in range(hashes.tables):
                bucket = bucket_of(slots[:, t], t)
                yield batch_of(schema, bucket, batch.column("entry"), batch.column("vector"), batch.column("ids"))

    return run


def query_rows(hashes: Hashes, count: int):
    schema = pa.schema([("bucket", pa.int64()), ("entry", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            slots, place = hashes.slots(unit_rows(stacked(batch.column("vector"))))
            for i, entry in enumerate(batch.column("entry").to_pylist()):
                near = [
                    bucket_of(probes(place[i, t], count) + slots[i, t], t)
                    for t in range(hashes.tables)
                ]
                near = np.concatenate(near)
                yield batch_of(schema, near, [entry] * len(near))

    return run


def stacked(column: pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(v.as_buffer(), "<f8") for v in column])


def to_binary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sound vectors as doubles, one after the other."""
    schema = pa.schema([("id", pa.int64()), ("size", pa.int32()), ("vector", pa.binary())])
    for batch in batches:
        rows = []
        for i, v in zip(batch.column("id").to_pylist(), batch.column("vector").to_pylist()):
            if i is None or not v or None in v:
                continue
            x = np.array(v, "<f8")
            if np.isfinite(x).all() and x.any():
                rows.append((i, len(x), (x + 0.0).tobytes()))
        if rows:
            yield batch_of(schema, *zip(*rows))


def rank_group(k: int):
    """Best ``k`` ids of each query in one part of one bucket."""

    def run(key, entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(entries) or not len(queries):
            return pd.DataFrame({"entry": [], "vec_id": [], "score": []})
        x = np.stack([np.frombuffer(v, "<f8") for v in entries["vector"]])
        q = np.stack([np.frombuffer(v, "<f8") for v in queries["vector"]])
        xn, qn = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
        copies = entries["ids"].map(len).to_numpy()
        own = queries["entry"].to_numpy()
        out = []
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            near = (part @ x.T) / qn[at : at + 256, None] / xn[None, :]
            if len(x) > k + 1:
                least = np.partition(near, len(x) - k - 1, axis=1)[:, len(x) - k - 1]
            else:
                least = np.full(len(part), -2.0)
            i, j = np.nonzero(near >= least[:, None] - TOLERANCE)
            score = (part[i] * x[j]).sum(1) / (qn[at + i] * xn[j])
            who = np.repeat(np.arange(len(i)), copies[j])
            ids = np.concatenate([entries["ids"].to_numpy()[b] for b in j]) if len(j) else np.zeros(0, np.int64)
            row, score = i[who], score[who]
            order = np.lexsort((ids, -score, row))
            row, score, ids = row[order], score[order], ids[order]
            first = np.searchsorted(row, row, "left")
            # one more than asked for, as a query's own id is taken out later
            keep = np.arange(len(row)) - first < k + 1
            out.append(pd.DataFrame({"entry": own[at + row[keep]], "vec_id": ids[keep], "score": score[keep]}))
        return pd.concat(out)

    return run


def by_score(key: str):
    return Window.partitionBy(key).orderBy(F.desc("score"), "vec_id")


def smallest_ids(rows: DataFrame, k: int) -> DataFrame:
    """(entry, ids): the ``k`` smallest ids of each entry.

    Taken in 64 salted parts of an entry first, so one with very many copies
    never meets in one task.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    for key in (("entry", "salt"), ("entry",)):
        place = F.row_number().over(Window.partitionBy(*key).orderBy("id"))
        salted = salted.withColumn("place", place).where(F.col("place") <= k).drop("place")
    return salted.groupBy("entry").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def nearest(
    vectors: DataFrame,
    queries: Callable[[Column], Column],
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    projections: int = PROJECTIONS,
    width: float = WIDTH,
    recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` nearest among those found.

    ``queries`` makes of the id column the condition that a vector is a query.
    """
    spark = vectors.sparkSession
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    sound = stage(given.mapInArrow(to_binary, "id bigint, size int, vector binary"), "vectors")
    sizes = sound.groupBy("size").count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sound = sound.where(F.col("size") == sizes["size"])
    hashes = Hashes(sizes["size"], tables, projections, width)

    # entries: distinct vectors, with as many of their smallest ids as a result can need
    apart = sound.select(F.xxhash64("vector").alias("hash"), "vector", "id")
    groups = apart.groupBy("hash", "vector").agg(F.min("id").alias("entry"), F.count("*").alias("n"))
    entries = stage(groups.select("entry", "vector", "n"), "vectors")
    single = entries.where("n = 1").select("entry", "vector", F.array("entry").alias("ids"))
    copied = sound.join(entries.where("n > 1").select("entry", "vector"), "vector")
    least = stage(smallest_ids(copied.select("entry", "id"), k + 1), "vectors")
    several = entries.where("n > 1").select("entry", "vector").join(least, "entry")
    entries = stage(single.unionByName(several), "vectors")

    few = entries.orderBy(F.xxhash64("entry")).limit(SAMPLE).select("vector").collect()
    sample = np.stack([np.frombuffer(bytes(r.vector), "<f8") for r in few])
    count = fit_probes(sample, hashes, k, recall)

    asked = sound.where(queries(F.col("id"))).select("id", "vector").distinct()
    asked = asked.join(entries.select("entry", "vector"), "vector").select("id", "entry", "vector")
    asked = stage(asked, "vectors")
    distinct = stage(asked.groupBy("entry", "vector").agg(F.count("*").alias("n")).drop("n"), "vectors")

    index = entries.mapInArrow(index_rows(hashes), "bucket bigint, entry bigint, vector binary, ids array<bigint>")
    parts = index.groupBy("bucket").count()
    parts = stage(parts.select("bucket", F.ceil(F.col("count") / CHUNK).cast("int").alias("parts")), "buckets")
    part = F.pmod(F.xxhash64("entry"), F.col("parts")).cast("int").alias("part")
    index = index.join(parts, "bucket").select("bucket", part, "entry", "vector", "ids")
    wanted = distinct.mapInArrow(query_rows(hashes, count), "bucket bigint, entry bigint")
    wanted = wanted.join(parts, "bucket").select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "entry"
    )
    wanted = wanted.join(distinct, "entry").select("bucket", "part", "entry", "vector")
    ranked = (
        index.groupBy("bucket", "part")
        .cogroup(wanted.groupBy("bucket", "part"))
        .applyInPandas(rank_group(k), "entry bigint, vec_id bigint, score double")
    )
    best = stage(ranked.groupBy("entry", "vec_id").agg(F.max("score").alias("score")), "candidates")
    best = best.withColumn("place", F.row_number().over(by_score("entry"))).where(F.col("place") <= k + 1)
    mine = asked.select("id", "entry").join(best, "entry").where("id != vec_id")
    rank = F.row_number().over(by_score("id")).alias("rank")
    return mine.select(F.col("id").alias("query_id"), rank, "vec_id", "score").where(F.col("rank") <= k)
