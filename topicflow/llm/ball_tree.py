"""Ranked lexical search: exact largest inner products by a sparse ball tree.

A document is a sparse vector of term impacts, a query one of term weights; the score is
their inner product in whole numbers.  Only terms of some query matter, so tasks keep the
documents' terms of the queries' vocabulary.  A first pass stages them with the documents'
lengths, a second one builds trees and searches.

A task cuts its documents into shards and halves each shard again and again between two
documents far apart, down to LEAF documents.  A node holds the centroid of its documents and
a radius per band of terms: the most frequent terms have bands of their own, the others share
RARE_BANDS.  The inner product with any document of the node is at most that with the
centroid plus, per band, the query's length times the radius; terms are scaled by the root of
their weight first, which makes the bound tighter.  Radii and bounds are floating point and
rounded up by more than their error, so a node is left out only if it cannot hold a result.
A query goes through a tree best bound first until the bound is below its last result so far,
which it takes along from shard to shard; leaves are scored exactly, in 64-bit integers.

Every task passes on its best few documents of each query.  These are ranked in parts of
tasks, then together, so no task sees more than a share of them.  Queries go out in blocks
of about BLOCK_BYTES of text, read by the driver one at a time from a staged table; each block
is one search over all documents, staged before the next begins.

Null texts have no terms.  Documents without any term take no part in the counts; queries
without any have no rows.  Rows with repeated or null ids are documents and queries of their
own; of equal scores the smaller id comes first, null before all.  Texts of any length are
rows of one vector.  Extra columns are left out.  Empty tables give no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, documents, numbered, prefix_totals, slices, stage
from topicflow.llm.decontaminate import words

LEAF = 32
SHARD_DOCS = 4096
SHARD_TERMS = 1 << 21
OWN_BANDS = 192
RARE_BANDS = 64
BLOCK_BYTES = 8 << 20
#: What bounds are raised by, far above the error of sums of doubles.
SLACK = 1e-9
PARTS = 256
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Query:
    row: int
    terms: np.ndarray  # numbers in the block's vocabulary, ascending
    times: np.ndarray


def read_block(rows: list) -> tuple[dict[bytes, int], list[Query]]:
    """The vocabulary of a block of queries, and the queries in its numbers."""
    vocabulary: dict[bytes, int] = {}
    queries = []
    for row, text in rows:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(text)]
        if ids:
            queries.append(Query(row, *np.unique(np.array(ids, np.int64), return_counts=True)))
    return vocabulary, queries


VECTORS = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))]
)
VECTORS_DDL = "doc_id bigint, n bigint, terms array<int>, times array<int>"


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times): each document's length and its terms of the vocabulary."""
    size = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            split = [words(t) for t in batch.column("text").to_pylist()]
            n = np.array([len(s) for s in split], np.int64)
            found = map(vocabulary.get, chain.from_iterable(split), iter(lambda: -1, None))
            ids = np.fromiter(found, np.int64, int(n.sum()))
            doc = np.repeat(np.arange(len(n)), n)[ids >= 0]
            key, times = np.unique(doc * size + ids[ids >= 0], return_counts=True)
            ends = np.searchsorted(key, np.arange(len(n) + 1) * size).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (key % size, times)]
            yield batch_of(VECTORS, batch.column("doc_id"), n, *lists)

    return documents(docs).mapInArrow(run, VECTORS_DDL).filter("n > 0")


@dataclass(frozen=True)
class Weights:
    """What the whole corpus says about a block's terms."""

    docs: int
    length: int
    weight: np.ndarray  # per term
    band: np.ndarray

    @staticmethod
    def of(docs: int, length: int, df: np.ndarray) -> Weights:
        ratio = [math.log((2 * docs + 2) / (2 * f + 1)) for f in df.tolist()]
        weight = np.array([math.floor(1000 * x) for x in ratio], np.int64)
        band = np.empty(len(df), np.int64)
        order = np.argsort(-df, kind="stable")
        band[order] = [i if i < OWN_BANDS else OWN_BANDS + i % RARE_BANDS for i in range(len(df))]
        return Weights(docs, length, weight, band)

    def impacts(self, n: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Per entry the part of the score besides the weight."""
        m = 75 + 25 * n * self.docs // self.length
        return 1_000_000_000 * times // (1000 * times + 12 * m)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from each start on, as many as its size, one run after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class Tree:
    """A ball tree over the documents of a shard, each with one term at least."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, impacts: np.ndarray, weights: Weights):
        self.own, local = np.unique(terms, return_inverse=True)  # the shard's terms
        self.band = weights.band[self.own]
        self.scale = np.sqrt(weights.weight[self.own].astype(float))
        self.starts = np.cumsum(sizes) - sizes
        self.sizes, self.local = sizes, local
        self.value = impacts * self.scale[local]
        self.norm = np.add.reduceat(self.value**2, self.starts)
        self.order = np.arange(len(ids))
        self.first: list[int] = []
        self.last: list[int] = []
        self.children: list[tuple[int, int] | None] = []
        self.radii: list[np.ndarray] = []
        centroids: list[tuple[np.ndarray, np.ndarray]] = []
        todo = [(0, len(ids), -1)]
        while todo:
            lo, hi, parent = todo.pop()
            node = len(self.first)
            self.first.append(lo)
            self.last.append(hi)
            self.children.append(None)
            if parent >= 0:
                had = self.children[parent]
                self.children[parent] = (node,) if had is None else (*had, node)
            centroid = self.ball(lo, hi)
            at = np.nonzero(centroid)[0]
            centroids.append((at, centroid[at]))
            if hi - lo > LEAF:
                middle = self.halve(lo, hi, centroid)
                todo += [(lo, middle, node), (middle, hi, node)]
        # centroids by term, so that a query reads the nodes that have its terms
        size = [len(at) for at, _ in centroids]
        term = np.concatenate([at for at, _ in centroids])
        by = np.argsort(term, kind="stable")
        self.node = np.repeat(np.arange(len(size)), size)[by]
        self.centre = np.concatenate([c for _, c in centroids])[by]
        self.postings = np.searchsorted(term[by], np.arange(len(self.own) + 1))
        self.radius = np.array(self.radii)
        # documents in the order of the leaves
        at = ranges(self.starts[self.order], sizes[self.order])
        self.ids, self.sizes = ids[self.order], sizes[self.order]
        self.local, self.impact = local[at], impacts[at]
        self.starts = np.cumsum(self.sizes) - self.sizes

    def entries(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        docs = self.order[lo:hi]
        return ranges(self.starts[docs], self.sizes[docs]), np.repeat(np.arange(hi - lo), self.sizes[docs])

    def ball(self, lo: int, hi: int) -> np.ndarray:
        """Centroid of some documents; their radii per band go to the list."""
        at, doc = self.entries(lo, hi)
        term, value = self.local[at], self.value[at]
        centroid = np.bincount(term, value, len(self.own)) / (hi - lo)
        bands = OWN_BANDS + RARE_BANDS
        here = doc * bands + self.band[term]
        far = np.bincount(here, value * (value - 2 * centroid[term]), (hi - lo) * bands).reshape(-1, bands).max(0)
        most = np.bincount(here, value**2, (hi - lo) * bands).reshape(-1, bands).max(0)
        own = np.bincount(self.band, centroid**2, bands)
        self.radii.append(np.sqrt(np.maximum(far + own, 0) + SLACK * (most + own)))
        return centroid

    def halve(self, lo: int, hi: int, centroid: np.ndarray) -> int:
        """Put the documents nearer to one of two far ones first; equal ones are cut by place."""
        at, doc = self.entries(lo, hi)
        term, value = self.local[at], self.value[at]
        norm = self.norm[self.order[lo:hi]]

        def distances(point: np.ndarray) -> np.ndarray:
            return norm - 2 * np.bincount(doc, value * point[term], hi - lo)

        def vector(i: int) -> np.ndarray:
            out = np.zeros(len(self.own))
            out[term[doc == i]] = value[doc == i]
            return out

        one = vector(int(np.argmax(distances(centroid))))
        other = vector(int(np.argmax(distances(one))))
        side = np.bincount(doc, value * (other - one)[term], hi - lo)
        self.order[lo:hi] = self.order[lo:hi][np.argsort(side, kind="stable")]
        return (lo + hi) // 2

    def search(self, query: Query, weights: Weights, best: list[tuple[int, int]], k: int) -> int:
        """Bring a query's best (score, -id) up to date; returns the number of leaves opened."""
        at = np.searchsorted(self.own, query.terms)
        there = np.minimum(at, len(self.own) - 1)
        have = self.own[there] == query.terms
        local, times = there[have], query.times[have]
        if not len(local):
            return 0
        weight = weights.weight[self.own[local]] * times
        scaled = self.scale[local] * times
        size = self.postings[local + 1] - self.postings[local]
        found = ranges(self.postings[local], size)
        bound = np.bincount(self.node[found], self.centre[found] * np.repeat(scaled, size), len(self.first))
        length = np.sqrt(np.bincount(self.band[local], scaled**2, self.radius.shape[1]))
        used = np.nonzero(length)[0]
        bound += self.radius[:, used] @ length[used]
        bound += SLACK * bound + 1
        dense = np.zeros(len(self.own), np.int64)
        dense[local] = weight
        heap, opened = [(-float(bound[0]), 0)], 0
        while heap:
            above, node = heapq.heappop(heap)
            least = best[0][0] if len(best) == k else 1
            if -above < least:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    heapq.heappush(heap, (max(above, -float(bound[child])), child))
                continue
            opened += 1
            lo, hi = self.first[node], self.last[node]
            begin = self.starts[lo]
            end = self.starts[hi - 1] + self.sizes[hi - 1]
            score = np.add.reduceat(dense[self.local[begin:end]] * self.impact[begin:end], self.starts[lo:hi] - begin)
            for i in np.nonzero(score >= least)[0].tolist():
                entry = (int(score[i]), -int(self.ids[lo + i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                else:
                    heapq.heappushpop(best, entry)
        return opened


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(ids, lengths, sizes, terms, times) of runs of documents with a term of the vocabulary."""
    for batch in batches:
        ids = batch.column("doc_id").fill_null(NO_ID + 1).to_numpy(zero_copy_only=False)
        n = batch.column("n").to_numpy(zero_copy_only=False)
        ends = batch.column("terms").offsets.to_numpy().astype(np.int64)
        term, times = (batch.column(c).values.to_numpy(zero_copy_only=False) for c in ("terms", "times"))
        start = 0
        while start < len(ids):
            last = int(np.searchsorted(ends, ends[start] + SHARD_TERMS, "right")) - 1
            stop = min(max(last, start + 1), start + SHARD_DOCS, len(ids))
            size = np.diff(ends[start : stop + 1])
            some = slice(int(ends[start]), int(ends[stop]))
            keep = size > 0
            if keep.any():
                yield ids[start:stop][keep], n[start:stop][keep], size[keep], term[some], times[some]
            start = stop


FOUND = pa.schema([("query", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("opened", pa.int64())])


def search(staged: DataFrame, queries: list[Query], weights: Weights, k: int) -> DataFrame:
    """(query, doc_id, score, opened, part): the best ``k`` documents of each query in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        opened = 0
        for ids, n, sizes, terms, times in shards(batches):
            impacts = weights.impacts(np.repeat(n, sizes), times.astype(np.int64))
            tree = Tree(ids, sizes, terms, impacts, weights)
            for query, found in zip(queries, best):
                opened += tree.search(query, weights, found, k)
        rows = [(q.row, -i, s, opened) for q, found in zip(queries, best) for s, i in found]
        if rows:
            row, ids, score, leaves = zip(*rows)
            ids = pa.array([None if i == NO_ID + 1 else i for i in ids], pa.int64())
            yield batch_of(FOUND, row, ids, score, leaves)

    found = staged.mapInArrow(run, "query bigint, doc_id bigint, score bigint, opened bigint")
    return found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(PARTS)))


def first_of(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def blocks(queries: DataFrame) -> DataFrame:
    """(row, block, text) of staged queries, in blocks of about BLOCK_BYTES and one text at most more."""
    sized = queries.select(
        "row", "text", F.shiftright("row", 33).alias("task"), (F.octet_length("text") + 64).cast("long").alias("size")
    )
    before = Window.partitionBy("task").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    here = sized.withColumn("at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = here.join(prefix_totals(sized, "task", "size"), "task")
    return placed.select("row", "text", F.expr(f"(base + at) div {BLOCK_BYTES}").alias("block"))


def search_lexical(docs: DataFrame, items: DataFrame, k: int = 20, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item, scores above 0 only."""
    own = items.select(F.col(item_col).alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    own, row = numbered(own, "search-items")
    own = own.withColumnRenamed(row, "row")
    placed = stage(blocks(own), "search-blocks")
    numbers = sorted(r.block for r in placed.select("block").distinct().toLocalIterator())
    out = None
    for number in numbers:
        rows = placed.filter(F.col("block") == number).orderBy("row").select("row", "text").collect()
        vocabulary, queries = read_block(rows)
        if not queries:
            continue
        staged = stage(vectors(docs, vocabulary), "search-vectors")
        totals = staged.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
        if not totals.docs:
            break
        seen = staged.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        df = np.zeros(len(vocabulary), np.int64)
        df[seen.column("term").to_numpy()] = seen.column("count").to_numpy()
        found = search(staged, queries, Weights.of(totals.docs, totals.length, df), k)
        best = first_of(first_of(found, ["query", "part"], k), ["query"], k).select("query", "rank", "doc_id", "score")
        best = stage(best, "search-found")
        out = best if out is None else out.unionAll(best)
    names = own.select("item_id", F.col("row").alias("query"))
    if out is None:
        none = "cast(null as int) as rank", "cast(null as bigint) as doc_id", "cast(null as bigint) as score"
        return names.selectExpr("item_id", *none).filter(F.lit(False))
    return out.join(names, "query").select("item_id", "rank", "doc_id", "score")
