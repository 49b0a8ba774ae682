"""Byte-level BPE by a finite-state transducer that is made deterministic on demand.

A text is cut by the vocabulary's pattern; each match is encoded by itself.  Merging by
rank has one result, and a row of tokens is that result exactly if each token and each
two neighbours come out of the merges as they are.  So the merges compile into a
nondeterministic transducer: it guesses where the next token began, and a guess lives
while its bytes still begin some token; when they are one and the token may follow the
last one, the guess ends there.  At every byte exactly one guess ends.

A state of the deterministic machine is the set of living guesses with the tokens each
would add.  Tokens that all of them share are emitted at once, so the lookahead is no
longer than the longest token.  States and moves are made when a text first needs them
and kept by the process, up to KEPT_STATES; then the machine starts anew.

Decoding reads ids in chunks and puts out whole characters only: a state machine over
UTF-8 bytes tells how many bytes at the end of a chunk wait for the next one.

Null texts count as empty and have no ids.  A text of any length is one row; it takes
memory in proportion to its own length.  Rows with null or repeated doc_ids are rows of
their own.  Extra columns are left out.  An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import gc
import re
from array import array
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicflow.llm.common import batch_of, documents, slices
from topicflow.llm.tokens import leading_space_pieces, process_state

KEPT_STATES = 300_000
KEPT_PAIRS = 500_000
#: Encoded pieces of text that a process remembers: at most twice so many.
KEPT_PIECES = 300_000
KEPT_LENGTH = 48
CHUNK_IDS = 1 << 16
SLICE_IDS = 1 << 19
NO_TOKEN = -1
SINGLE = [bytes([b]) for b in range(256)]
STOPS = tuple(".,;:!?")

# Letters and numbers of the regex library's Unicode version that the tiktoken
# library's older one does not have; there they are neither.
NEWER_RANGES = """
558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF
10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F
12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2
18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF
1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
NEWER = "".join("-".join(chr(int(x, 16)) for x in r.split("-")) for r in NEWER_RANGES.split())


class Merges:
    """Tokens by rank, and the tree of merges that builds each of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[int, bool] = {}
        self.halves: dict[bytes, tuple[bytes, bytes] | None] = {}
        self.edges: dict[tuple[int, bool], list[tuple[bytes, float]]] = {}

    def merge(self, text: bytes, down_to: int = 1) -> list[bytes]:
        """The adjacent pair of lowest rank, leftmost first, becomes one, until none or so many are left."""
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > down_to:
            found = [self.ranks.get(a + b) for a, b in zip(parts, parts[1:])]
            best = min((rank for rank in found if rank is not None), default=None)
            if best is None:
                break
            i = found.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def split(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge is this one; None for a single byte or if merges never build it."""
        if token not in self.halves:
            parts = self.merge(token, 2) if len(token) > 1 else []
            if len(parts) == 2 and max(self.ranks[p] for p in parts) > self.ranks[token]:
                raise ValueError("a token's rank is below that of its parts")
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    def stands(self, rank: int) -> bool:
        """Whether the merges build this token from its bytes."""
        token = self.tokens[rank]
        return len(token) == 1 or self.split(token) is not None

    def edge(self, rank: int, last: bool) -> list[tuple[bytes, float]]:
        """The tokens at one end of a token while it is merged, each with the rank that ends it."""
        if (rank, last) not in self.edges:
            found, part, ends = [], self.tokens[rank], float("inf")
            while part is not None:
                found.append((part, ends))
                ends, halves = self.ranks[part], self.split(part)
                part = halves[last] if halves else None
            self.edges[rank, last] = found[::-1]
        return self.edges[rank, last]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merges leave these two tokens side by side as they are.

        Merges go by rank, so the tokens at the border change as the ranks go up;
        the border falls if the two there merge before either of them is merged away.
        """
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is not None:
            return known
        if len(self.pairs) > KEPT_PAIRS:
            self.pairs.clear()
        before, after, i, j = self.edge(left, True), self.edge(right, False), 0, 0
        stays = True
        while i < len(before) and j < len(after):
            (a, a_ends), (b, b_ends) = before[i], after[j]
            rank = self.ranks.get(a + b)
            # of equal ranks the leftmost pair goes first
            if rank is not None and rank < a_ends and rank <= b_ends:
                stays = False
                break
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1
        self.pairs[pair] = stays
        return stays


class Transducer:
    """Bytes of one match to token ids.

    A guess is (bytes since the token began, the token before it, tokens not yet emitted).
    """

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} of the 256 single bytes")
        self.merges = Merges(ranks)
        self.begins = {token[:i] for token in ranks for i in range(1, len(token))}
        self.reset()

    def reset(self) -> None:
        start = ((b"", NO_TOKEN, ()),)
        self.states = [start]
        self.numbers = {start: 0}
        #: (next state, tokens emitted) by state * 256 + byte.
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def determinise(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The move of a state on a byte: (next state, tokens it emits)."""
        merges, living, ended, new = self.merges, [], None, SINGLE[byte]
        for seen, last, waiting in self.states[state]:
            seen += new
            if seen in self.begins:
                living.append((seen, last, waiting))
            if ended is None:
                rank = merges.ranks.get(seen)
                if rank is not None and merges.stands(rank):
                    if last == NO_TOKEN or merges.may_follow(last, rank):
                        ended = (b"", rank, (*waiting, rank))
        living.append(ended)
        emitted, shared = ended[2], 0
        fewest = min([len(waiting) for _, _, waiting in living])
        while shared < fewest and all([g[2][shared] == emitted[shared] for g in living]):
            shared += 1
        if shared:
            living = [(seen, last, waiting[shared:]) for seen, last, waiting in living]
            emitted = emitted[:shared]
        else:
            emitted = ()
        move = self.moves[state << 8 | byte] = (self.number(tuple(living)), emitted)
        return move

    def number(self, guesses: tuple) -> int:
        found = self.numbers.get(guesses)
        if found is None:
            found = self.numbers[guesses] = len(self.states)
            self.states.append(guesses)
        return found

    def encode(self, text: bytes) -> list[int]:
        whole = self.merges.ranks.get(text)
        if whole is not None:
            return [whole]
        if len(self.states) > KEPT_STATES:
            self.reset()
        known, state, out = self.moves.get, 0, []
        for byte in text:
            move = known(state << 8 | byte)
            if move is None:
                move = self.determinise(state, byte)
                if len(self.states) > 2 * KEPT_STATES:  # a single long match: go on from here alone
                    here = self.states[move[0]]
                    self.reset()
                    move, known = (self.number(here), move[1]), self.moves.get
            state, emitted = move
            if emitted:
                out += emitted
        out += self.states[state][-1][2]
        return out


class Encoder:
    """Texts to ids; pieces between single spaces repeat, so their ids are remembered."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.machine = Transducer(read_ranks(path))
        compiled = regex.compile(pattern)
        self.matches, self.scan = compiled.findall, compiled.finditer
        self.newer = re.compile(f"[{NEWER}]")
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        """All matches of the pattern."""
        if text.isascii() or not self.newer.search(text):
            return self.matches(text)
        return [text[a:b] for a, b in (m.span() for m in self.scan(self.newer.sub("\ue000", text)))]

    def piece(self, text: str) -> bytes:
        """Ids of a piece, remembered or made now.

        Letters are one match, with or without a space before them, and a stop or the like
        after them is another, so most pieces need no pattern.
        """
        ids = self.older.get(text)
        if ids is None:
            core = text[1:] if text[:1] == " " else text
            if core.isalpha():
                ids = array("i", self.machine.encode(text.encode())).tobytes()
            elif core[-1:] in STOPS and core[:-1].isalpha():
                ids = (self.recent.get(text[:-1]) or self.piece(text[:-1])) + self.piece(core[-1])
            else:
                out: list[int] = []
                for match in self.split(text):
                    out += self.machine.encode(match.encode())
                ids = array("i", out).tobytes()
        if len(text) <= KEPT_LENGTH:
            if len(self.recent) >= KEPT_PIECES:
                self.older, self.recent = self.recent, {}
            self.recent[text] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        pieces = leading_space_pieces(text)
        found = list(map(self.recent.get, pieces))
        if None in found:
            found = [self.piece(p) if ids is None else ids for p, ids in zip(pieces, found)]
        return np.frombuffer(b"".join(found), np.int32)


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens in base64 and their ranks, one pair a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file) if token}


def _leading(byte: int) -> int:
    """How many bytes a character that begins with this byte has; 0 if none does."""
    if byte < 0x80:
        return 1
    return 2 if 0xC2 <= byte < 0xE0 else 3 if 0xE0 <= byte < 0xF0 else 4 if 0xF0 <= byte < 0xF5 else 0


#: Range of the second byte where it is narrower than 80 to BF.
SECOND = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}


class Utf8:
    """The state of an unfinished character: how many bytes it still needs, and the next one's range."""

    def __init__(self):
        self.needed, self.low, self.high = 0, 0x80, 0xBF

    def step(self, byte: int) -> bool:
        """Take one byte; False if it cannot stand here, which leaves the start state."""
        if not self.needed:
            size = _leading(byte)
            self.needed = max(size - 1, 0)
            self.low, self.high = SECOND.get(byte, (0x80, 0xBF))
            return size > 0
        fits = self.low <= byte <= self.high
        self.needed = self.needed - 1 if fits else 0
        self.low, self.high = 0x80, 0xBF
        return fits


class Decoder:
    """Chunks of ids to text; characters cut by a chunk's end wait for the next chunk."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.kept = b""

    def feed(self, ids: Iterable[int]) -> tuple[bytes, str]:
        """The bytes of these ids, and the text of all characters that are complete by now."""
        new = b"".join(map(self.tokens.__getitem__, ids))
        data = self.kept + new
        end = self._complete(data)
        self.kept = data[end:]
        return new, data[:end].decode("utf-8", "replace")

    def finish(self) -> str:
        kept, self.kept = self.kept, b""
        return kept.decode("utf-8", "replace")

    @staticmethod
    def _complete(data: bytes) -> int:
        """Length without a last character that has begun well but is not finished."""
        for back in range(1, min(3, len(data)) + 1):
            if data[-back] & 0xC0 != 0x80:  # the last byte that can begin a character
                state = Utf8()
                if all(state.step(b) for b in data[-back:]) and state.needed:
                    return len(data) - back
                break
        return len(data)


def _own(path: str, pattern: str) -> Encoder:
    kept = process_state("bpe")
    if (path, pattern) not in kept:
        kept[path, pattern] = Encoder(path, pattern)
    return kept[path, pattern]


@contextmanager
def without_cycles() -> Iterator[None]:
    """No search for garbage cycles: none arise here, and states and pieces are many objects."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def id_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about SLICE_IDS ids, or of one longer row."""
    for batch in batches:
        sizes = np.cumsum([len(row) if row.is_valid else 0 for row in batch.column("ids")])
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, base + SLICE_IDS, "right")))
            yield batch.slice(start, end - start)
            start = end


IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
IDS_DDL = "doc_id bigint, ids array<int>"
TEXTS = pa.schema([*IDS, ("decoded", pa.binary()), ("text", pa.string())])
TEXTS_DDL = IDS_DDL + ", decoded binary, text string"


def encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    own = _own(path, pattern)
    for batch in slices(batches):
        with without_cycles():
            rows = [own.encode(text) for text in batch.column("text").to_pylist()]
        ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
        ids = pa.array(np.concatenate(rows), pa.int32())
        yield batch_of(IDS, batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), ids))


def decoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    kept = process_state("bpe_tokens")
    if path not in kept:
        kept[path] = {rank: token for token, rank in read_ranks(path).items()}
    for batch in id_slices(batches):
        raw, texts = [], []
        for row in batch.column("ids"):
            ids = row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.empty(0, np.int32)
            decoder, parts = Decoder(kept[path]), []
            for i in range(0, len(ids), CHUNK_IDS):
                parts.append(decoder.feed(ids[i : i + CHUNK_IDS].tolist()))
            raw.append(b"".join(p for p, _ in parts))
            texts.append("".join(t for _, t in parts) + decoder.finish())
        yield batch_of(TEXTS, batch.column("doc_id"), batch.column("ids"), raw, texts)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every row, in no order; no shuffle."""
    return documents(docs, id_col, text_col).mapInArrow(lambda b: encoded(b, path, pattern), IDS_DDL)


def decode(ids: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded, text): the bytes of the ids, and their text in which bytes
    that are no UTF-8 are U+FFFD.  An id the vocabulary lacks fails the job."""
    rows = ids.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(lambda b: decoded(b, path), TEXTS_DDL)


def encode_and_decode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """What ``decode`` makes of what ``encode`` gives, in one pass."""
    rows = documents(docs, id_col, text_col)
    return rows.mapInArrow(lambda b: decoded(encoded(b, path, pattern), path), TEXTS_DDL)
