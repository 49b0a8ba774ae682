"""SimHash near-duplicates, linked by a range join on segment popcounts.

A fingerprint's bits are cut into segments of two; the count of set bits in each
is a coordinate.  The Manhattan distance of two such points is never above the
Hamming distance of the fingerprints, so all wanted pairs lie within it.  The
coordinates are halved: one half of a wanted pair is within ``distance // 2``, and
then both points reach a common grid point in half of that many steps.  Every
fingerprint is therefore written to the cells around it in both halves, and cells
are checked exactly.

A cell gives no pairs but a forest that connects its members as all its links
would: from each member outwards, those within the distance that were not yet
reached.  Equal fingerprints are one member, whatever the number of documents.
Cells above CELL_ROWS members are dealt out as pairs of salted parts, so no task
holds more than two parts of one, and no link is lost.

Null and empty texts, and texts of spaces, have fingerprint 0 and are linked like
others.  Rows with a null doc_id take part; the smallest id of a component leaves
them out, and is null only where there is no other.  Repeated ids are rows of
their own, extra columns are left out, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, numbered, slices, stage
from topicflow.llm.components import components

SHINGLE = 4
SEED = 42
DISTANCE = 4
CELL_ROWS = 1 << 13
#: Cells of up to so many members are compared in bulk, pair by pair.
SMALL_CELL = 16

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_hashes(text: str, width: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, or of all words if there are fewer."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64_intdigest(joined, seed)], np.uint64)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *[e + 1 for e in ends[:-1]]]
    return np.array(
        [xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends[width - 1 :])], np.uint64
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, as a signed long."""
    set_bits = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        part = hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    width: int = SHINGLE,
    seed: int = SEED,
    row_col: str | None = None,
) -> DataFrame:
    """(row, doc_id, fp) of every row; ``row`` is ``row_col`` or numbers the rows as they are read."""
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                fingerprint(shingle_hashes(t or "", width, seed))
                for t in batch.column("text").to_pylist()
            ]
            yield batch_of(schema, batch.column("row"), batch.column("doc_id"), found)

    rows = docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).cast("string").alias("text"),
    )
    return rows.mapInArrow(run, "row bigint, doc_id bigint, fp bigint")


# ------------------------------------------------------------------ the grid


def half_points(fps: np.ndarray, half: int) -> np.ndarray:
    """Popcounts of 16 segments of two bits, as two-bit digits of one number."""
    bits = (fps.view(np.uint64) >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
    low = bits & np.uint64(0x55555555)
    high = (bits >> np.uint64(1)) & np.uint64(0x55555555)
    return (low + high).astype(np.int64)


def steps_around(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point with itself and every grid point one step away: (row, cell)."""
    rows, cells = [np.arange(len(points))], [points]
    for k in range(16):
        digit = (points >> (2 * k)) & 3
        up, down = np.nonzero(digit < 2)[0], np.nonzero(digit > 0)[0]
        rows += [up, down]
        cells += [points[up] + (1 << 2 * k), points[down] - (1 << 2 * k)]
    return np.concatenate(rows), np.concatenate(cells)


def cells_of(distance: int):
    """Cells of a fingerprint in both halves: those within ceil((distance // 2) / 2) steps."""
    rounds = -(-(distance // 2) // 2)
    schema = pa.schema([("cell", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column("fp").to_numpy()
            for at in range(0, len(every), 4096):
                fps = every[at : at + 4096]
                for half in (0, 1):
                    row, cell = np.arange(len(fps)), half_points(fps, half)
                    for _ in range(rounds):
                        near, cell = steps_around(cell)
                        row = row[near]
                    if rounds > 1:
                        row, cell = np.unique(np.stack([row, cell]), axis=1)
                    yield batch_of(schema, cell | half << 40, fps[row])

    return run


def near_pairs(cell: np.ndarray, fps: np.ndarray, distance: int):
    """Links inside runs of equal cells: every one in small runs, a forest in others."""
    edge = np.nonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))[0]
    sizes = np.diff(edge)
    run = np.repeat(sizes, sizes)
    left, right = [], []
    for gap in range(1, min(SMALL_CELL, int(sizes.max(initial=1)))):
        i = np.nonzero((cell[gap:] == cell[:-gap]) & (run[gap:] <= SMALL_CELL))[0]
        i = i[np.bitwise_count(fps[i] ^ fps[i + gap]) <= distance]
        left.append(fps[i])
        right.append(fps[i + gap])
    for a, b in zip(edge[:-1][sizes > SMALL_CELL], edge[1:][sizes > SMALL_CELL]):
        for x, reached in forest(np.unique(fps[a:b]), distance):
            left.append(np.full(len(reached), x, np.uint64))
            right.append(reached)
    return np.concatenate(left) if left else fps[:0], np.concatenate(right) if right else fps[:0]


def forest(members: np.ndarray, distance: int):
    """(member, those first reached from it): connects all that are linked, once each."""
    rest = members
    while len(rest):
        ahead, rest = [rest[0]], rest[1:]
        while ahead and len(rest):
            x = ahead.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                yield x, rest[near]
                ahead.extend(rest[near])
                rest = rest[~near]


class Joined:
    """Links that connect what this task has not connected yet, so that few leave it."""

    LIMIT = 1 << 18

    def __init__(self):
        self.root: dict[int, int] = {}

    def find(self, x: int) -> int:
        root = self.root
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    def fresh(self, left: list[int], right: list[int]) -> list[tuple[int, int]]:
        if len(self.root) > self.LIMIT:
            self.root.clear()
        out = []
        for a, b in zip(left, right):
            x, y = self.find(a), self.find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                out.append((a, b))
        return out


def link_cells(distance: int):
    """Rows sorted by cell (and part) to links (a, b)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined = Joined()

        def links(cell, fps):
            left, right = near_pairs(cell, fps.view(np.uint64), distance)
            pairs = joined.fresh(left.view(np.int64).tolist(), right.view(np.int64).tolist())
            if pairs:
                yield batch_of(schema, *zip(*pairs))

        held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            cell = np.concatenate([held[0], batch.column("cell").to_numpy()])
            fps = np.concatenate([held[1], batch.column("fp").to_numpy()])
            if not len(cell):
                continue
            last = int(np.searchsorted(cell, cell[-1], "left"))  # the last run may go on
            yield from links(cell[:last], fps[:last])
            held = cell[last:], fps[last:]
        if len(held[0]):
            yield from links(*held)

    return run


def near_links(fps: DataFrame, distance: int = DISTANCE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints exactly as all pairs within ``distance`` would."""
    spread = fps.mapInArrow(cells_of(distance), "cell bigint, fp bigint")
    crowded = spread.groupBy("cell").count().where(F.col("count") > cell_rows)
    crowded = crowded.select("cell", F.ceil(F.col("count") / cell_rows * 2).cast("int").alias("parts"))
    dealt = spread.join(crowded, "cell", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    # a member of a crowded cell goes to every pair of parts that holds its own
    pairs = F.transform(others, lambda o: F.least(own, o) * F.col("parts") + F.greatest(own, o) + 1)
    dealt = dealt.select(
        "cell", "fp", F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("part")
    )
    mixed = F.when(F.col("part") == 0, F.col("cell")).otherwise(F.xxhash64("cell", "part"))
    dealt = dealt.select(mixed.alias("cell"), "fp")
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(n, "cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(link_cells(distance), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
    distance: int = DISTANCE,
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id, row, stays.

    ``component_id`` is the smallest doc_id of the component; ``stays`` holds for one row
    of each, the first of those with that id; ``row`` is ``row_col``, which a staged table must
    hold if it is to be joined by, or numbers the rows as they are read.
    """
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    rows = stage(fingerprints(docs, id_col, text_col, width, seed, row_col), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min(place).alias("least")), "fingerprints")
    roots = components(near_links(classes.select("fp"), distance))
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("first"))
    named = placed.join(least, "root").select("fp", "first")
    return rows.join(named, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        "row",
        (F.col("row") == F.col("first.row")).alias("stays"),
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE,
    seed: int = SEED,
    distance: int = DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows, row = numbered(docs, "near-duplicates")
    found = near_duplicates(rows, id_col, text_col, width, seed, distance, row)
    gone = found.where("NOT stays").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
