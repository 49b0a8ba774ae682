"""Benchmark passages in training documents, by suffix arrays over training shards.

A shard is a run of documents of about SHARD_BYTES in one task.  Its words become
numbers of the benchmark's vocabulary (0: a word the benchmark lacks), and the
suffixes that begin with two words as some benchmark item has them side by side
are sorted into a suffix array, as deep as the longest item.  Others match no
item beyond one word, so they are left out (a one-word item keeps its own).
Every suffix of every item is then looked up by binary search: the range of
equal suffixes gives all places of its window, and extending them the longest
verbatim match.  Nothing is shuffled, and a document's result comes from one task.

The benchmark goes out in blocks of about BLOCK_WORDS words, one pass over the
documents for each, so its size has no limit.  Items are told apart by item_id; a
null one counts as an empty text.  Null texts have no words.  Rows with a null or
repeated doc_id are documents of their own.  Extra columns are left out.  Without
items, or without words in them, no document has hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, numbered, stage

SHARD_BYTES = 6 << 20
BLOCK_WORDS = 1 << 21
WINDOW = 10

#: A-Z to lower case, all other ASCII but digits and a-z to spaces; bytes of longer characters stay.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

FOUND = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.list_(pa.int64()))),
        ("longest", pa.int64()),
        ("items", pa.list_(pa.string())),
    ]
)
FOUND_DDL = (
    "row bigint, doc_id bigint, n_words bigint, spans array<array<bigint>>, longest bigint, "
    "items array<string>"
)


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split()


class Block:
    """Suffixes of benchmark items, and their windows by content."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary
        windows: dict[tuple[int, ...], set[str]] = {}
        ids: list[int] = []
        firsts: dict[tuple[int, ...], int] = {}
        self.longest = 0
        for item, text in items:
            seq = [number.setdefault(w, len(number) + 1) for w in words(text)]
            width = min(window, len(seq))
            self.longest = max(self.longest, len(seq))
            for i in range(len(seq) - width + 1 if seq else 0):
                key = tuple(seq[i : i + width])
                windows.setdefault(key, set()).add(item)
                firsts.setdefault(key, len(ids) + i)
            ids += [*seq, 0]
        self.ids = np.array(ids, np.int64)
        self.windows = list(windows)
        self.items = [sorted(windows[w]) for w in self.windows]
        self.sizes = np.array([len(w) for w in self.windows], np.int64)
        self.places = np.array([firsts[w] for w in self.windows], np.int64)
        self.bits = max(1, len(number).bit_length())
        self.per = 62 // self.bits
        pairs = {p for w in self.windows for p in zip(w, w[1:])}
        self.pairs = np.array(sorted(a << self.bits | b for a, b in pairs), np.int64)
        self.single = np.array(sorted({w[0] for w in self.windows if len(w) == 1}), np.int64)


def packed(ids: np.ndarray, at: np.ndarray, per: int, bits: int, count: int | np.ndarray) -> np.ndarray:
    """``per`` ids from each place on in one number; only the first ``count`` of them."""
    out = np.zeros(len(at), np.int64)
    for k in range(per):
        here = ids[np.minimum(at + k, len(ids) - 1)]
        here = np.where((at + k < len(ids)) & (k < count), here, 0)
        out = out << bits | here
    return out


def suffix_array(ids: np.ndarray, starts: np.ndarray, per: int, bits: int, depth: int) -> np.ndarray:
    """Places in order of the words from there on, up to ``depth``; only ties are looked at again."""
    order = starts[np.argsort(packed(ids, starts, per, bits, per), kind="stable")]
    key = packed(ids, order, per, bits, per)
    group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]).astype(np.int64)])) if len(key) else key
    done = per
    while done < depth and len(order) > 1:
        size = np.bincount(group)
        tied = np.nonzero(size[group] > 1)[0]
        if not len(tied):
            break
        key = packed(ids, order[tied] + done, per, bits, per)
        fine = np.lexsort((key, group[tied]))
        order[tied] = order[tied][fine]
        key, old = key[fine], group[tied]
        same = np.ones(len(order), bool)
        same[0] = False
        same[1:] = group[1:] == group[:-1]
        split = np.zeros(len(tied), bool)
        split[1:] = (key[1:] != key[:-1]) & (old[1:] == old[:-1])
        same[tied[split]] = False
        group = np.cumsum(~same) - 1
        done += per
    return order


def search(
    ids: np.ndarray, order: np.ndarray, q: list[np.ndarray], size: np.ndarray, per: int, bits: int, after: bool
) -> np.ndarray:
    """Where each wanted run of words would stand in the suffix array, before or after its equals."""
    lo, hi = np.zeros(len(size), np.int64), np.full(len(size), len(order), np.int64)
    while True:
        open_ = np.nonzero(lo < hi)[0]
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        less, equal = np.zeros(len(open_), bool), np.ones(len(open_), bool)
        for r, wanted in enumerate(q):
            count = np.clip(size[open_] - r * per, 0, per)
            have = packed(ids, order[mid] + r * per, per, bits, count)
            less |= equal & (have < wanted[open_])
            equal &= have == wanted[open_]
        right = less | equal if after else less
        lo[open_[right]] = mid[right] + 1
        hi[open_[~right]] = mid[~right]


def match_shard(docs: list[list[bytes]], block: Block, window: int):
    """Per document: words, spans that are hit, longest match, items; None where nothing is hit."""
    get = block.vocabulary.get
    n = np.array([len(d) for d in docs], np.int64)
    first = np.concatenate([[0], np.cumsum(n + 1)])
    ids = np.zeros(int(first[-1]) + 1, np.int64)
    for at, d in zip(first, docs):
        ids[at : at + len(d)] = np.fromiter(map(get, d, repeat(0)), np.int64, len(d))
    none = [(int(k), [], 0, []) for k in n]
    if not block.windows:
        return none
    follows = np.isin(ids[:-1] << block.bits | ids[1:], block.pairs) & (ids[:-1] > 0)
    if len(block.single):
        follows |= np.isin(ids[:-1], block.single)
    starts = np.nonzero(follows)[0]
    if not len(starts):
        return none
    per, bits = block.per, block.bits
    order = suffix_array(ids, starts, per, bits, block.longest)
    rounds = -(-int(block.sizes.max()) // per)
    wide = np.zeros((len(block.windows), rounds * per), np.int64)
    for i, w in enumerate(block.windows):
        wide[i, : len(w)] = w
    q = []
    for r in range(rounds):
        key = np.zeros(len(wide), np.int64)
        for k in range(per):
            key = key << bits | wide[:, r * per + k]
        q.append(key)
    lo = search(ids, order, q, block.sizes, per, bits, False)
    hi = search(ids, order, q, block.sizes, per, bits, True)
    count = hi - lo
    which = np.repeat(np.arange(len(count)), count)
    if not len(which):
        return none
    place = order[np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + lo[which]]
    size = block.sizes[which]
    doc = np.searchsorted(first, place, "right") - 1
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + size, -1)
    covered = np.concatenate([[False], np.cumsum(cover)[:-1] > 0, [False]])
    edge = np.nonzero(covered[1:] != covered[:-1])[0]
    begin, end = edge[::2], edge[1::2]
    spans: dict[int, list[list[int]]] = {}
    for d, a, b in zip(np.searchsorted(first, begin, "right") - 1, begin, end):
        spans.setdefault(int(d), []).append([int(a - first[d]), int(b - first[d])])
    longest = longest_matches(ids, place, which, block)
    best: dict[int, int] = {}
    names: dict[int, set[str]] = {}
    order_ = np.lexsort((which, doc))
    seen = np.ones(len(order_), bool)
    seen[1:] = (doc[order_][1:] != doc[order_][:-1]) | (which[order_][1:] != which[order_][:-1])
    for d, w in zip(doc[order_][seen], which[order_][seen]):
        names.setdefault(int(d), set()).update(block.items[w])
    for d, x in zip(doc, longest):
        best[int(d)] = max(best.get(int(d), 0), int(x))
    return [
        (int(k), spans[i], best[i], sorted(names[i])) if i in spans else none[i]
        for i, k in enumerate(n)
    ]


def longest_matches(ids: np.ndarray, place: np.ndarray, which: np.ndarray, block: Block) -> np.ndarray:
    """Words that match from each place on, along the first item that has its window."""
    item = block.places[which]
    size = block.sizes[which].copy()
    open_ = np.arange(len(place))
    while len(open_):
        a = np.minimum(place[open_] + size[open_], len(ids) - 1)
        b = np.minimum(item[open_] + size[open_], len(block.ids) - 1)
        open_ = open_[(ids[a] == block.ids[b]) & (ids[a] > 0)]
        size[open_] += 1
    return size


def scan(items: list[tuple[str, str]], window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(items, window)
        rows, docs, size = [], [], 0

        def close():
            found = match_shard(docs, block, window)
            return batch_of(FOUND, *zip(*[(*r, *f) for r, f in zip(rows, found)]))

        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows.append((row, doc_id))
                docs.append(words(text or ""))
                size += len(text or "")
                if size >= SHARD_BYTES:
                    yield close()
                    rows, docs, size = [], [], 0
        if rows:
            yield close()

    return run


def benchmark_rows(
    items: DataFrame, item_col: str, text_col: str, block_words: int
) -> tuple[DataFrame, int]:
    """The benchmark's rows, and the number of blocks they are to be dealt to."""
    rows = items.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    count = max(1, -(-int(size) // block_words))
    return rows, count


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: row, doc_id, n_words, n_hit, spans of word places, longest match, items.

    ``row`` is ``row_col``, which a staged table must hold if it is to be joined by, or
    numbers the rows of ``docs`` as they are read.
    """
    rows, blocks = benchmark_rows(items, item_col, item_text_col, block_words)
    docs = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    if blocks > 1 and not row_col:
        docs = stage(docs, "decontaminate")
    part = F.pmod(F.xxhash64("item"), F.lit(blocks))
    found = None
    for k in range(blocks):
        mine = [(r.item, r.text) for r in rows.where(part == k).collect()]
        one = docs.mapInArrow(scan(mine, window), FOUND_DDL)
        found = one if found is None else found.unionByName(one)
    if blocks > 1:
        found = stage(found, "decontaminate").groupBy("row").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.max("longest").alias("longest"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    # spans are in order of their starts; those of several blocks may overlap
    hit = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s[1] - F.greatest(s[0], a["to"]), F.lit(0))).alias("n"),
            F.greatest(a["to"], s[1]).alias("to"),
        ),
        lambda a: a["n"],
    )
    return found.select("row", "doc_id", "n_words", hit.alias("n_hit"), "spans", "longest", "items")


def drop_contaminated(docs: DataFrame, items: DataFrame, least_hit: int = 1, **options) -> DataFrame:
    """The rows of ``docs`` with fewer than ``least_hit`` hit words, with all their columns."""
    rows, row = numbered(docs, "decontaminate")
    found = contamination(rows, items, row_col=row, **options)
    gone = stage(found.where(F.col("n_hit") >= least_hit).select(F.col("row").alias(row)), "hits")
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
