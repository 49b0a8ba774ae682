"""Tokenizing with the tokenizers library, a piece of text at a time.

Both vocabularies split a text at spaces before they merge anything, so the ids
of a text are the ids of its pieces, one after the other.  Pieces repeat, within a batch
and beyond.  Arrow cuts a batch of texts, finds its different pieces and leaves the stops
off plain words.  Each process keeps the ids of words, stops and other pieces it has met
lately, in two generations: when the newer one is full it becomes the older, which alone
is forgotten, and what is met again moves to the newer.  They are kept as Arrow strings
and one array of ids, since workers live on and hold them beside the work of later tasks.
New plain words go to the library's BPE model itself, many at a time, anything else
through its whole pipeline.

The library is told that strings of special tokens in a text are ordinary text, as the
vocabularies' own description does; a plain call would give them the special id.  A lone
surrogate cannot occur in a string of Spark's.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Sequence
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces of a generation; a process keeps two.
KEPT_PIECES = 500_000
#: Longer pieces are not kept.
KEPT_LENGTH = 48
#: Text bytes of a batch: more of them repeat more pieces.
BATCH_BYTES = 8 << 20
#: Words that the BPE model gets at once.
WORDS_AT_ONCE = 500
#: A word between two others; no word of letters holds its id.
BETWEEN = "\n!\n"

ODD_SPACES = re.compile("[  -     　]")
NARROW_SPACES = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
SINGLE_SPACE = re.compile(r"(?<=\S)(?= \S)")
# both vocabularies part letters from other signs; an apostrophe can begin a short form
WORD = re.compile(r"( ?)([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)")
STOPS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
# what ``Encoder.word`` may know, and stops after it; letters up to U+024F
LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
LATIN_WORD = rf"\A ?[{LATIN}]+[!-&(-/:-@\[-`{{-~]*\z"
LATIN_LETTERS = " " + "".join(c for c in map(chr, range(0x250)) if re.match(f"[{LATIN}]", c))
# texts that ``leading_space_pieces`` does not cut at every space and line break
ODD = "  |\n\n|\n | \n|\\A | \\z|[" + NARROW_SPACES + ODD_SPACES.pattern[1:]


def leading_space_pieces(text: str) -> list[str]:
    """Cut before each single space and around each single line break.

    Both only between characters that are no white space, where a new match of
    the vocabulary's pattern begins whatever comes before.
    """
    odd = (
        "  " in text
        or "\n\n" in text
        or "\n " in text
        or " \n" in text
        or text[:1] == " "
        or text[-1:] == " "
        or any(c in text for c in NARROW_SPACES)
        or (not text.isascii() and ODD_SPACES.search(text))
    )
    if odd:
        return SINGLE_SPACE.split(text)
    pieces = text.replace("\n", " \n ").replace(" ", "\0 ").split("\0") if "\0" not in text else None
    if pieces is None:
        return SINGLE_SPACE.split(text)
    if "\n" in text:
        out, bare = [], False
        for piece in pieces:
            if piece == " \n":
                out.append("\n")
                bare = True
            elif bare:
                out.append(piece[1:])
                bare = False
            else:
                out.append(piece)
        return out
    return pieces


def plain_pieces(text: str) -> list[str]:
    """Words between spaces, for vocabularies that drop white space."""
    return text.replace("\n", " ").split(" ")


def byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray, which: np.ndarray):
    """(ids, sizes) of the chosen runs of ``flat``, one after the other."""
    count = size[which]
    upto = np.cumsum(count)
    at = np.repeat(first[which] - (upto - count), count)
    return flat[at + np.arange(len(at))], count


class Kept:
    """Different pieces and their ids, in arrays."""

    def __init__(self, dtype: str):
        self.names = pa.array([""], pa.string())
        self.flat = np.zeros(0, dtype)
        self.first = np.zeros(1, np.int64)
        self.size = np.zeros(1, np.int32)

    def __len__(self) -> int:
        return len(self.names)

    def __contains__(self, piece: str) -> bool:
        return bool(pc.any(pc.equal(self.names, piece)).as_py())

    def __or__(self, other: Kept) -> set[str]:
        return {*self.names.to_pylist(), *other.names.to_pylist()}

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Where each piece stands, -1 for those that are not here."""
        found = pc.fill_null(pc.index_in(pieces, value_set=self.names), -1)
        return found.to_numpy(zero_copy_only=False).astype(np.int64)

    def add(self, names: pa.Array, flat: np.ndarray, size: np.ndarray) -> None:
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(size) - size])
        self.names = pa.concat_arrays([self.names, names])
        self.flat = np.concatenate([self.flat, flat])
        self.size = np.concatenate([self.size, size.astype(np.int32)])


class Encoder:
    """Texts to little-endian ids, two bytes each, or four in a large vocabulary."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        # the same model for words that are already in the vocabulary's letters
        self.words = Tokenizer(self.library.model)
        self.words.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        (self.mark,) = self.words.encode("!", add_special_tokens=False).ids
        self.code = "H" if self.library.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.lower = '"invert":true' in self.library.to_str().replace(" ", "")
        self.pieces = plain_pieces if self.lower else leading_space_pieces
        self.letters = byte_letters()
        self.dtype = f"<u{self.width}"
        self.known, self.older = Kept(self.dtype), Kept(self.dtype)

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [array(self.code, x.ids).tobytes() for x in found]

    def word(self, piece: str) -> tuple[str, str] | None:
        """A plain word in the vocabulary's letters and the stops after it; None for anything else."""
        m = WORD.fullmatch(piece)
        if m is None:
            return None
        space, core, end = m.groups()
        if not core.isascii():
            if max(core) > "ɏ":
                return None
            if self.lower:
                core = unicodedata.normalize("NFC", core)
        if self.lower:
            core = core.lower()
        if not core.isascii():
            if not core.isalpha():
                return None
            core = core.encode().decode("latin-1").translate(self.letters)
        return (self.letters[32] + core if space and not self.lower else core), end

    def model_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of words in the vocabulary's letters, from the BPE model."""
        flat, sizes = [np.zeros(0, self.dtype)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), WORDS_AT_ONCE):
            some = words[at : at + WORDS_AT_ONCE]
            (found,) = self.words.encode_batch_fast([BETWEEN.join(some)], add_special_tokens=False)
            ids = np.array(found.ids, self.dtype)
            marks = ids == self.mark
            flat.append(ids[~marks])
            sizes.append(np.diff(np.flatnonzero(marks), prepend=-1, append=len(ids)) - 1)
        return np.concatenate(flat), np.concatenate(sizes)

    def new_ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of different words, stops and other pieces that no generation has."""
        rest, words = [], {}
        which = np.zeros(len(pieces), np.int64)
        for i, found in enumerate(map(self.word, pieces)):
            if found is None or found[1]:
                which[i] = -1 - len(rest)
                rest.append(pieces[i])
            else:
                which[i] = words.setdefault(found[0], len(words))
        flat, size = self.model_ids(list(words))
        others = self.whole(rest) if rest else []
        which = np.where(which < 0, len(words) - 1 - which, which)
        flat = np.concatenate([flat, np.frombuffer(b"".join(others), self.dtype)])
        size = np.concatenate([size, np.fromiter(map(len, others), np.int64, len(others)) // self.width])
        return gathered(flat, np.cumsum(size) - size, size, which)

    def parts(self, pieces: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Different words, stops and other pieces, and which two of them each piece is made of."""
        word = pc.match_substring_regex(pieces, LATIN_WORD)
        stem = pc.if_else(word, pc.ascii_rtrim(pieces, characters=STOPS), pieces)
        shorter = pc.less(pc.binary_length(stem), pc.binary_length(pieces))
        ends = pc.utf8_ltrim(pieces.filter(shorter), characters=LATIN_LETTERS)
        coded = pa.concat_arrays([stem, ends, pa.array([""], pa.string())]).dictionary_encode()
        at = coded.indices.to_numpy(zero_copy_only=False)
        end = np.full(len(pieces), at[-1])
        end[shorter.to_numpy(zero_copy_only=False)] = at[len(pieces) : -1]
        return coded.dictionary, at[: len(pieces)], end

    def ids_of(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of different words, stops and other pieces, which are kept."""
        known, older = self.known, self.older
        place = known.places(pieces)
        lost = np.flatnonzero(place < 0)
        lacking = pieces.take(pa.array(lost))
        before = older.places(lacking)
        again, unmet = before >= 0, before < 0
        flat, size = self.new_ids(lacking.filter(pa.array(unmet)).to_pylist())
        place[lost[again]] = len(known) + before[again]
        place[lost[unmet]] = len(known) + len(older) + np.arange(len(size))
        runs = [(x.flat, x.first, x.size) for x in (known, older)] + [(flat, np.cumsum(size) - size, size)]
        begin = np.cumsum([0] + [len(x[0]) for x in runs])
        flat, first, size = (
            np.concatenate(x)
            for x in ([r[0] for r in runs], [r[1] + b for r, b in zip(runs, begin)], [r[2] for r in runs])
        )
        if len(known) > KEPT_PIECES:
            self.older, self.known = known, Kept(self.dtype)
        short = pc.less_equal(pc.utf8_length(lacking), KEPT_LENGTH)
        kept = lost[short.to_numpy(zero_copy_only=False)]
        self.known.add(pieces.take(pa.array(kept)), *gathered(flat, first, size, place[kept]))
        return gathered(flat, first, size, place)

    def cut(self, texts: pa.Array) -> pa.ListArray:
        """The pieces of every text."""
        if self.lower:
            return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        odd = pc.match_substring_regex(texts, ODD)
        apart = pc.replace_substring(texts, "\n", "\0\n\0")
        apart = pc.replace_substring(apart, " ", "\0 ")
        if pc.any(odd).as_py():
            own = ["\0".join(self.pieces(t)) for t in texts.filter(odd).to_pylist()]
            apart = pc.replace_with_mask(apart, odd, pa.array(own, apart.type))
        return pc.split_pattern(apart, "\0")

    def encode(self, texts: Sequence[str] | pa.Array) -> list[bytes]:
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        # the mark between pieces must not stand in a text
        marked = np.flatnonzero(pc.match_substring(texts, "\0").to_numpy(zero_copy_only=False))
        if len(marked) and not self.lower:
            apart = self.whole(texts.take(pa.array(marked)).to_pylist())
            mask = np.zeros(len(texts), bool)
            mask[marked] = True
            out = self.encode(pc.if_else(pa.array(mask), pa.scalar("", texts.type), texts))
            for i, ids in zip(marked.tolist(), apart):
                out[i] = ids
            return out
        cut = self.cut(texts)
        coded = cut.flatten().dictionary_encode()
        parts, stem, end = self.parts(coded.dictionary.cast(pa.string()))
        flat, size = self.ids_of(parts)
        flat, two = gathered(flat, np.cumsum(size) - size, size, np.stack([stem, end], 1).ravel())
        size = two.reshape(-1, 2).sum(1)
        # every place takes its ids from those of the different pieces
        which = coded.indices.to_numpy(zero_copy_only=False)
        flat, count = gathered(flat, np.cumsum(size) - size, size, which)
        raw, upto = flat.tobytes(), np.concatenate([[0], np.cumsum(count)])
        ends = np.cumsum(pc.list_value_length(cut).to_numpy(zero_copy_only=False))
        ends = (upto[ends] * self.width).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


def process_state(name: str) -> dict:
    """A dict that outlives tasks: functions are sent by value, so module variables do not."""
    return sys.modules.setdefault(f"topicflow_{name}", ModuleType(name)).__dict__


def encoder(path: str) -> Encoder:
    """The process's own encoder for a vocabulary file."""
    encoders = process_state("encoders")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def id_type(path: str) -> str:
    """numpy's name for the width of a vocabulary's ids."""
    return "<u2" if encoder(path).code == "H" else "<u4"
