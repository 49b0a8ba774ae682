"""Ball-tree search, phrase mining and the BPE transducer against brute force and the library."""

import codecs
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from topicflow.llm import ball_tree, bpe, phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id bigint, text string, lang string, score double, rank string, query string, row int"


def text_of(rng, n):
    some = "red green Blue stone Éclair river7 éclair Straße walks under over the a of to".split()
    return " ".join(rng.choice(some) + rng.choice(["", "", ".", "\n", "x", "-7", "\tand", ": "]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    body = text_of(rng, 50)
    return [
        (4, body, "en", 1.0, "r", None, 1),
        (3, body, "en", None, None, None, None),
        (3, body, None, None, None, None, None),
        (None, body, "de", None, None, None, None),
        (7, None, "de", None, None, None, None),
        (8, "", "fr", None, None, None, None),
        (9, " .\n\t ,", "fr", None, None, None, None),
        (10, "stone", "und", None, None, None, None),
        (11, text_of(rng, 20_000), "en", None, None, None, None),
        (12, "the the the the the the the. the the", "de", None, None, None, None),
        *[(20 + i, text_of(rng, 5 + i), rng.choice(["en", "de"]), None, None, None, None) for i in range(60)],
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def best_documents(texts, items, k):
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in texts]
    terms = [(i, c, c.total()) for i, c in terms if c]
    docs, length = len(terms), sum(n for _, _, n in terms)
    df = Counter(t for _, c, _ in terms for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in terms:
            m, score = 100 - 25 + 25 * n * docs // length, 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score:
                found.append((-score, -math.inf if i is None else i, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: x[:2])[:k], 1)]
    return out


ITEMS = [
    ("1", "red stone, Red river7"), ("2", "the of to a"), ("2", "the of to a"), (None, "ÉCLAIR Éclair x"),
    ("3", None), ("4", ""), ("5", "absent words only"), ("6", " ".join(["walks under"] * 500)),
]


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_search_finds_the_same_as_all_scores(spark, docs, texts, monkeypatch, block):
    monkeypatch.setattr(ball_tree, "BLOCK_BYTES", block)
    items = spark.createDataFrame([(i, t, 3) for i, t in ITEMS], "item_id string, text string, doc_id int")
    rows = ball_tree.search_lexical(docs, items.repartition(2), k=7).collect()
    wanted = best_documents([t[:2] for t in texts], ITEMS, 7)
    assert sorted(map(key, rows)) == sorted(map(key, wanted))


def test_search_in_empty_tables(spark, docs, empty):
    items = spark.createDataFrame([("1", "red")], "item_id string, text string")
    for d, i in ((empty, items), (docs, items.limit(0)), (docs, items.selectExpr("item_id", "'' as text"))):
        found = ball_tree.search_lexical(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_tree_prunes_and_keeps_ties():
    rng = np.random.default_rng(3)
    groups = [rng.integers(0, 40, 12) + 100 * g for g in range(8)]
    rows = [np.unique(rng.choice(groups[d % 8], 6)) for d in range(2000)]
    rows += [rows[0]] * 300  # equal documents, more than a leaf
    sizes = np.array([len(r) for r in rows])
    times = rng.integers(1, 5, sizes.sum())
    times[-300 * sizes[-1] :] = np.tile(times[: sizes[0]], 300)
    df = np.bincount(np.concatenate(rows), minlength=800)
    weights = ball_tree.Weights.of(len(rows), int(times.sum()), df)
    n = np.add.reduceat(times, np.cumsum(sizes) - sizes)
    impacts = weights.impacts(np.repeat(n, sizes), times)
    ids = rng.permutation(len(rows))
    tree = ball_tree.Tree(ids, sizes, np.concatenate(rows), impacts, weights)
    dense = np.zeros((len(rows), 800), np.int64)
    dense[np.repeat(np.arange(len(rows)), sizes), np.concatenate(rows)] = impacts
    opened = 0
    for at in range(40):
        query = ball_tree.Query(0, rows[at], np.full(len(rows[at]), 2))
        best = []
        opened += tree.search(query, weights, best, 25)
        score = dense[:, rows[at]] @ (2 * weights.weight[rows[at]])
        wanted = sorted((-s, i) for s, i in zip(score.tolist(), ids.tolist()) if s)[:25]
        assert sorted((-s, -i) for s, i in best) == wanted
    leaves = sum(c is None for c in tree.children)
    assert opened < 0.5 * 40 * leaves


def mined(texts, longest, at_least, first):
    count, out = {}, []
    for lang, text in texts:
        f = count.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            f.update(tuple(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    for lang, f in count.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        often = {p: v for p, v in f.items() if v >= at_least}
        inside = Counter()
        for p, v in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], v)
        found = []
        for p, a in often.items():
            if len(p) > 1 and inside[p] < a:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


@pytest.mark.parametrize("at_least,first,longest", [(3, 10_000, 5), (40, 20, 5), (100, 5, 2), (5, 50, 3)])
def test_phrases_are_those_of_full_counts(docs, texts, at_least, first, longest):
    rows = phrases.collocations(docs, longest, at_least, first).collect()
    assert sorted(map(tuple, rows)) == sorted(mined([(t[2], t[1]) for t in texts], longest, at_least, first))


def test_a_useless_proposal_changes_no_count(docs, texts, monkeypatch):
    """With a sample of nothing all that is frequent is a failure; with a full filter nothing is."""
    wanted = sorted(mined([(t[2], t[1]) for t in texts], 5, 10, 1000))
    monkeypatch.setattr(phrases, "SAMPLE", 0.0)
    none = phrases.frequent_phrases(docs, 5, 10, sample=0.0)
    some = phrases.frequent_phrases(docs, 5, 10, sample=0.5)
    assert sorted(map(tuple, none.collect())) == sorted(map(tuple, some.collect()))
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: none)
    assert sorted(map(tuple, phrases.collocations(docs, 5, 10, 1000).collect())) == wanted


def test_chunks_and_crowded_filters_keep_counts(monkeypatch, texts):
    text = texts[8][1]
    full = phrases.Filter(np.full(1 << 13, 255, np.uint8), 16)
    wanted = Counter()
    for p, n in phrases.count_chunk(*next(phrases.chunks(phrases.words_of([text]), 4)), "en", 5, full, None):
        wanted.update(dict(zip(p, n.tolist())))
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 50)
    found = Counter()
    for chunk in phrases.chunks(phrases.words_of([text]), 4):
        for p, n in phrases.count_chunk(*chunk, "en", 5, full, None):
            found.update(dict(zip(p, n.tolist())))
    assert found == wanted and wanted[b""] == sum(n for p, n in wanted.items() if p and b" " not in p)


def test_phrases_of_an_empty_table(docs, empty):
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(docs, at_least=10**6).count() == 0


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH, public_tokenizers.PATTERN)


ODD = ["", " ", "  a", "it's  he'll 'S\n\n x", "<|endoftext|>", "\x1c a\x85 b\xa0", "a" * 5000, "é́ ́", "日本 語 😀😀", "12½ Ⅷ٣",
       chr(0x323B0) + chr(0x11DE0) + " a" + chr(0x558), "　x  y", "\r\n\t z ", "ǅ ß ŒUVRE naïve"]


def test_transducer_gives_the_library_s_ids(encoder, library):
    rng = random.Random(2)
    letters = "aB é.,'’\n\t  7ßΣ中😀\x1c\x85\xa0日ñ½Ⅷ٣" + chr(0x558) + chr(0x12550)
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(1, 30))) for _ in range(3000)]
    for text in ODD + mixed + words:
        assert encoder.encode(text).tolist() == library.encode_ordinary(text), repr(text)


def test_every_token_comes_out_of_its_own_merges_once(encoder):
    merges = encoder.machine.merges
    rng = random.Random(4)
    for rank in rng.sample(sorted(merges.tokens), 2000):
        assert merges.stands(rank) and merges.merge(merges.tokens[rank]) == [merges.tokens[rank]]
        other = rng.randrange(50_000)
        pair = merges.tokens[rank], merges.tokens[other]
        assert merges.may_follow(rank, other) == (merges.merge(b"".join(pair)) == [*pair])


def test_a_machine_that_starts_anew_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_STATES", 3)
    small, rng = bpe.Transducer(bpe.read_ranks(PATH)), random.Random(6)
    for _ in range(300):
        word = "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 40)))
        assert small.encode(word.encode()) == library.encode_ordinary(word)


def test_character_classes_are_the_library_s(encoder):
    every = "".join(chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000)
    ranks = bpe.read_ranks(PATH)
    hidden = encoder.newer.sub("", every)
    for one in (r"\p{L}", r"\p{N}", r"\s"):
        own = tiktoken.Encoding("one", pat_str=one, mergeable_ranks=ranks, special_tokens={})
        assert set(own.decode(own.encode_ordinary(every))) == set(regex.findall(one, hidden))


def test_round_trip_over_a_table(docs, texts, empty, library):
    encoded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, PATH).collect()
    at_once = bpe.encode_and_decode(docs, PATH, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in at_once) == Counter((r.doc_id, tuple(r.ids), r.text) for r in rows)
    got = Counter((r.doc_id, tuple(r.ids), bytes(r.decoded), r.text) for r in rows)
    assert got == Counter(
        (t[0], tuple(library.encode_ordinary(t[1] or "")), (t[1] or "").encode(), t[1] or "") for t in texts
    )
    assert bpe.decode(bpe.encode(empty, PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_streaming_decode_cuts_between_characters():
    tokens = {i: bytes([i]) for i in range(256)}
    rng = random.Random(8)
    data = [bytes(rng.choice(b"a\xc3\xa9\xe4\xb8\xad\xf0\x9f\x98\x80\xed\xa0\xff\x80") for _ in range(30)) for _ in range(2000)]
    for given in data + ["é中😀aé".encode() * 3]:
        decoder, parts = bpe.Decoder(tokens), []
        for byte in given:
            raw, text = decoder.feed([byte])
            assert raw == bytes([byte])
            parts.append(text)
        parts.append(decoder.finish())
        assert "".join(parts) == given.decode("utf-8", "replace")
        other = codecs.getincrementaldecoder("utf-8")("replace")
        wanted = [other.decode(bytes([b])) for b in given]
        if all(x not in "�" or not x for x in wanted):
            assert parts[:-1] == wanted


def test_unknown_ids_fail_and_null_ids_are_empty(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "doc_id bigint, ids array<int>")
    assert {(r.doc_id, bytes(r.decoded), r.text) for r in bpe.decode(rows, PATH).collect()} == {(1, b"", ""), (2, b"", "")}
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id bigint, ids array<int>"), PATH).collect()
