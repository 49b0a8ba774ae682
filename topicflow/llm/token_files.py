"""Token-ID files: interleaved range asymmetric numeral system with static tables.

``write_tokens`` encodes all texts in ascending id order and writes a folder:

* ``blocks``: one row per block, with ``file`` and ``block`` (its place), ``start``
  (ids before it in the file), ``doc_ids``, ``lengths`` (ids per document, end id
  included) and ``payload``, a byte string that can be decoded on its own;
* ``model``: one row, the frequency table that all blocks share;
* ``files``: ``file`` and ``base``, the ids in all earlier files.

Parquet holds the rows, so any store that Spark writes to will do.  A payload is
``RANS``, then as little-endian u32: version, lanes, count of ids, steps between
checkpoints, count of words, then per checkpoint the word position (u32) and the
state of each lane (u64), then the words (u32), then a crc32 of all that.  Id i
belongs to lane i % lanes.  A checkpoint is a place where decoding can start, so
parts of a block can be decoded in parallel too.

Null texts are empty ones and have the end id alone.  Rows with a null id come
first.  Rows that share an id stand side by side, ordered by their ids.  Extra
columns are left out.  An empty table gives an empty folder with a flat table.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, documents, give_back, new_folder, prefix_totals, slices, stage
from topicflow.llm.tokens import BATCH_BYTES, encoder, id_type

SCALE = 20
LOW = np.uint64(1 << 32)
HEAD = "<4s5I"
HEAD_SIZE = struct.calcsize(HEAD)
VERSION = 1
#: A block ends with the first document that brings it to so many ids.
BLOCK_IDS = 1 << 20
LANES = 4096
CHECKPOINT_STEPS = 128


# ------------------------------------------------------------------ the code


def scaled_frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts to frequencies of at least 1 that sum to 2^SCALE; deterministic."""
    room = (1 << SCALE) - len(counts)
    total = max(1, int(counts.sum()))
    freq = 1 + np.array([int(c) * room // total for c in counts], np.int64)
    freq[int(np.argmax(counts))] += (1 << SCALE) - int(freq.sum())
    return freq.astype(np.uint64)


class Tables:
    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.limit = self.freq << np.uint64(64 - SCALE)
        self.symbol = np.repeat(np.arange(len(freq)), self.freq.astype(np.int64)).astype(np.uint32)


def encode_block(ids: np.ndarray, t: Tables) -> bytes:
    n = len(ids)
    lanes = max(1, min(LANES, 1 << max(0, (n // 64).bit_length() - 1)))
    steps = -(-n // lanes)
    state = np.full(lanes, LOW, np.uint64)
    words, counts, points = [], [], []
    shift, low32, scale = np.uint64(32), np.uint64(0xFFFFFFFF), np.uint64(SCALE)
    for step in range(steps - 1, -1, -1):
        symbols = ids[step * lanes : (step + 1) * lanes]
        x, freq = state[: len(symbols)], t.freq[symbols]
        full = x >= t.limit[symbols]
        out = x[full]
        words.append((out & low32).astype("<u4"))
        counts.append(len(out))
        x[full] = out >> shift
        div = x // freq
        state[: len(symbols)] = (div << scale) + (x - div * freq) + t.start[symbols]
        if step % CHECKPOINT_STEPS == 0:
            points.append((len(counts), state.copy()))
    total = sum(counts)
    ahead = np.concatenate([[0], np.cumsum(counts)]).astype(int)
    parts = [struct.pack(HEAD, b"RANS", VERSION, lanes, n, CHECKPOINT_STEPS, total)]
    for done, saved in reversed(points):
        parts += [struct.pack("<I", total - ahead[done]), saved.astype("<u8").tobytes()]
    parts += [w.tobytes() for w in reversed(words)]
    body = b"".join(parts)
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(payload: bytes, t: Tables, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids first..last of a block, decoded from the nearest checkpoint before ``first``."""
    body = payload[:-4]
    if zlib.crc32(body) != struct.unpack("<I", payload[-4:])[0]:
        raise ValueError("checksum of a token block does not match")
    magic, version, lanes, n, every, total = struct.unpack_from(HEAD, body)
    if magic != b"RANS" or version != VERSION:
        raise ValueError("not a token block of this version")
    last = n if last is None else min(last, n)
    out = np.zeros(n, np.uint32)
    steps = -(-n // lanes)
    points = -(-steps // every)
    words = np.frombuffer(body, "<u4", total, HEAD_SIZE + points * (4 + 8 * lanes))
    step = begin = (first // lanes) // every * every
    place = HEAD_SIZE + begin // every * (4 + 8 * lanes)
    if first >= last:
        return out[:0]
    at = struct.unpack_from("<I", body, place)[0]
    state = np.frombuffer(body, "<u8", lanes, place + 4).astype(np.uint64)
    shift, scale, mask = np.uint64(32), np.uint64(SCALE), np.uint64((1 << SCALE) - 1)
    while step * lanes < last:
        width = min(lanes, n - step * lanes)
        x = state[:width]
        slot = x & mask
        symbols = t.symbol[slot]
        x = t.freq[symbols] * (x >> scale) + slot - t.start[symbols]
        low = x < LOW
        k = int(np.count_nonzero(low))
        x[low] = (x[low] << shift) | words[at : at + k]
        at += k
        state[:width] = x
        out[step * lanes : step * lanes + width] = symbols
        step += 1
    return out[first:last]


# ------------------------------------------------------------------ writing


def id_bounds(docs: DataFrame, files: int) -> list[int]:
    """At most ``files`` - 1 ids that part the documents about evenly; only ids are read."""
    wanted = [i / files for i in range(1, files)]
    if not wanted:
        return []
    return sorted({int(x) for x in docs.stat.approxQuantile("doc_id", wanted, 0.2 / files)})


PLACED = pa.schema([("file", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary())])
BLOCK = pa.schema(
    [
        ("file", pa.int32()),
        ("block", pa.int32()),
        ("start", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("ids", pa.binary()),
    ]
)
BLOCK_DDL = (
    "file int, block int, start bigint, n_ids bigint, doc_ids array<bigint>, "
    "lengths array<bigint>, ids binary"
)


def place_documents(path: str, end_id: int, bounds: list[int]):
    """Tokenize and say in which file, that is range of ids, a document goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encoder(path), np.array([end_id], id_type(path)).tobytes()
        for batch in slices(batches, size=BATCH_BYTES):
            doc_ids = batch.column("doc_id").to_pylist()
            ids = [x + end for x in code.encode(batch.column("text"))]
            known = np.array([-(1 << 62) if x is None else x for x in doc_ids], np.int64)
            file = np.searchsorted(np.array(bounds, np.int64), known, "left") if bounds else known * 0
            file = [0 if x is None else int(f) for x, f in zip(doc_ids, file)]
            yield batch_of(PLACED, file, doc_ids, ids)
            del ids
            give_back()

    return run


def form_blocks(width: int, block_ids: int):
    """Rows sorted by file and id to blocks of whole documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, block, start, docs, sizes, parts = None, 0, 0, [], [], []

        def close():
            return batch_of(
                BLOCK, [file], [block], [start], [sum(sizes)], [docs], [sizes], [b"".join(parts)]
            )

        for batch in batches:
            for f, doc, ids in zip(*(batch.column(i) for i in range(3))):
                f = f.as_py()
                if f != file or sum_of(sizes) >= block_ids:
                    if docs:
                        yield close()
                    if f != file:
                        file, block, start = f, 0, 0
                    else:
                        block, start = block + 1, start + sum(sizes)
                    docs, sizes, parts = [], Sizes(), []
                docs.append(doc.as_py())
                parts.append(ids.as_buffer().to_pybytes())
                sizes.append(len(parts[-1]) // width)
        if docs:
            yield close()

    return run


class Sizes(list):
    """A list that knows its sum."""

    def __init__(self):
        super().__init__()
        self.total = 0

    def append(self, x):
        super().append(x)
        self.total += x


def sum_of(sizes) -> int:
    return sizes.total if isinstance(sizes, Sizes) else sum(sizes)


def count_ids(dtype: str):
    """Per task the counts of all ids it has seen: as many rows as the vocabulary has ids at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for ids in batch.column("ids"):
                more = np.bincount(np.frombuffer(ids.as_buffer(), dtype))
                if len(more) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(more) - len(counts), np.int64)])
                counts[: len(more)] += more
        seen = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["id", "n"])

    return run


def encode_blocks(freq: bytes, dtype: str):
    schema = pa.schema([*list(BLOCK)[:-1], ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(np.frombuffer(freq, "<u4"))
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_buffer(), dtype)
                row = batch.slice(i, 1)
                payload = encode_block(ids, tables)
                yield batch_of(schema, *[row.column(k) for k in range(6)], [payload])

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    files: int | None = None,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Tokenize ``docs`` and write their ids to ``folder`` in ascending id order.

    Ranges of ids, not hashes, become files, so one shuffle of two-byte ids
    sorts the corpus.  Plain blocks are staged once: the first pass over them
    counts all ids for the shared table, the second encodes.
    """
    spark = docs.sparkSession
    docs = documents(docs, id_col, text_col)
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = id_bounds(docs.select("doc_id"), files)
    dtype = id_type(tokenizer)
    placed = docs.mapInArrow(
        place_documents(tokenizer, end_id, bounds), "file int, doc_id bigint, ids binary"
    )
    ordered = placed.repartitionById(len(bounds) + 1, F.col("file"))
    ordered = ordered.sortWithinPartitions("file", "doc_id", "ids")
    width = int(dtype[-1])
    plain = stage(ordered.mapInArrow(form_blocks(width, block_ids), BLOCK_DDL), "token-blocks")

    size = max(encoder(tokenizer).library.get_vocab_size(), end_id + 1)
    counts = np.zeros(size, np.int64)
    seen = plain.select("ids").mapInArrow(count_ids(dtype), "id bigint, n bigint")
    for row in seen.groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n  # one row per id of the vocabulary, which is fixed
    freq = scaled_frequencies(counts).astype("<u4").tobytes()

    schema = BLOCK_DDL.rpartition(", ")[0] + ", payload binary"
    plain.mapInArrow(encode_blocks(freq, dtype), schema).write.option(
        "compression", "uncompressed"
    ).parquet(f"{folder}/blocks")
    spark.createDataFrame([(freq,)], "freq binary").coalesce(1).write.parquet(f"{folder}/model")
    written = spark.read.schema(schema).parquet(f"{folder}/blocks")
    prefix_totals(written, "file", "n_ids").coalesce(1).write.parquet(f"{folder}/files")


# ------------------------------------------------------------------ reading

READ = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def decode_blocks(freq: bytes, with_ids: bool):
    schema = READ if with_ids else pa.schema(list(READ)[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = Tables(np.frombuffer(freq, "<u4"))
        for batch in batches:
            for i in range(batch.num_rows):
                ids = decode_block(batch.column("payload")[i].as_buffer().to_pybytes(), tables)
                lengths = batch.column("lengths")[i].values.to_numpy()
                cuts = np.concatenate([[0], np.cumsum(lengths)])
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cuts, cuts[1:])]
                start = batch.column("start")[i].as_py() + cuts[:-1]
                columns = [batch.column("doc_ids")[i].values, start, lengths, crc]
                if with_ids:
                    columns.append([ids[a:b] for a, b in zip(cuts, cuts[1:])])
                yield batch_of(schema, *columns)

    return run


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids of all before it), n_tokens, ids_crc32 and ids."""
    ddl = BLOCK_DDL.rpartition(", ")[0] + ", payload binary"
    blocks = spark.read.schema(ddl).parquet(f"{folder}/blocks")
    files = spark.read.schema("file int, base bigint").parquet(f"{folder}/files")
    freq = bytes(spark.read.parquet(f"{folder}/model").first().freq)
    placed = blocks.join(files, "file").select(
        (F.col("base") + F.col("start")).alias("start"), "doc_ids", "lengths", "payload"
    )
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return placed.mapInArrow(decode_blocks(freq, with_ids), schema + ", ids array<int>" * with_ids)


def encode_and_read(docs: DataFrame, tokenizer: str, end_id: int = 0, **options) -> DataFrame:
    folder = new_folder(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer, end_id, **options)
    return read_tokens(docs.sparkSession, folder, with_ids=False)
