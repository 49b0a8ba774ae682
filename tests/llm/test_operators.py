"""Each operator against brute force on small tables with nulls, empties, ties and odd columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from topicflow.llm import brown, components, decontaminate, language, nearest, packing, pii
from topicflow.llm import sentence_spans, simhash, token_files, tokens, toxicity
from topicflow.llm.common import fold
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, score double, row string"


def prose(rng, n):
    words = "red green Blue. river stone, éclair Straße walks\nunder over the a of to".split(" ")
    return " ".join(rng.choice(words) + rng.choice(["", "", "x", "7"]) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    body = prose(rng, 60)
    return [
        (5, body, "en", 1.0, "r"),
        (2, body, "en", None, None),
        (2, body, "en", None, None),
        (9, body.replace("stone", "Stone", 1), None, 0.0, ""),
        (None, prose(rng, 30), "de", None, None),
        (7, None, "de", None, None),
        (8, "", "fr", None, None),
        (11, "  \n ", "fr", None, None),
        (12, "one", "en", None, None),
        (13, prose(rng, 9000), "en", None, None),
        (14, "a" * 50_000, "en", None, None),
        *[(20 + i, prose(rng, 40 + i), "en", None, None) for i in range(8)],
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(texts, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def library_ids(name, text, end):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    library.encode_special_tokens = True
    return [*library.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = [
    "a  b", " a b ", "a\n b\xa0 c", "  ", "", "it 's a  \n\n test's <|endoftext|> \x1c b", "\0 a b",
    "é́ ́a  Σας ΣΑΣ 　 z", "a\nb\nC.\n", "\nx", "İstanbul ŒUVRE ǅ ß naïve, Éa.\nÇ", "12,345 x's", "a\r\nb\tc",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_give_the_ids_of_the_whole_text(name):
    mine = tokens.encoder(public_tokenizers.path(name))
    rng = random.Random(1)
    mixed = ["".join(rng.choice("aB é.,'’\n\t  7ßΣ") for _ in range(60)) for _ in range(400)]
    for given in (ODD + mixed, ODD + mixed):  # the second time from memory
        for text, ids in zip(given, mine.encode(given)):
            assert [*np.frombuffer(ids, "<u2"), 0] == library_ids(name, text, 0), repr(text)


def test_blocks_decode_from_any_checkpoint():
    rng = np.random.default_rng(1)
    for n in (1, 5, 700, 300_000):
        ids = np.minimum(rng.zipf(1.3, n), 50_000).astype(np.uint32)
        freq = token_files.scaled_frequencies(np.bincount(ids, minlength=50_257))
        assert freq.sum() == 1 << token_files.SCALE and freq.min() >= 1
        t = token_files.Tables(freq)
        payload = token_files.encode_block(ids, t)
        assert (token_files.decode_block(payload, t) == ids).all()
        a, b = n // 2, n // 2 + n // 3
        assert (token_files.decode_block(payload, t, a, b) == ids[a:b]).all()
    with pytest.raises(ValueError, match="checksum"):
        token_files.decode_block(payload[:-9] + b"\0" + payload[-8:], t)


def test_token_files(spark, docs, texts, empty, tmp_path):
    path, name = public_tokenizers.path("byte_bpe_50k.json"), "byte_bpe_50k.json"
    token_files.write_tokens(docs, str(tmp_path / "t"), path, files=3, block_ids=200)
    rows = sorted(token_files.read_tokens(spark, str(tmp_path / "t")).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((t[0] for t in texts), key=lambda i: -1 if i is None else i)
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    wanted = Counter((t[0], crc(library_ids(name, t[1], 0))) for t in texts)
    assert Counter((r.doc_id, r.ids_crc32) for r in rows) == wanted
    assert all(crc(r.ids) == r.ids_crc32 and len(r.ids) == r.n_tokens for r in rows)
    assert token_files.encode_and_read(empty, path).count() == 0


def test_packing(docs, texts, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.pack(docs, path, length=64).collect()
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    flat = [x for r in rows for x in r.ids]
    assert all(r.sequence_id * 64 + r.offset == at for r, at in zip(rows, np.cumsum([0, *[r.length for r in rows]])))
    parts = Counter(tuple(library_ids("word_bpe_49k.json", t[1], 2)) for t in texts)
    assert len(flat) == sum(len(p) * n for p, n in parts.items())
    assert sum(r.length for r in rows if r.doc_id == 13) == len(library_ids("word_bpe_49k.json", texts[9][1], 2))
    assert all(crc(r.ids) == r.ids_crc32 for r in rows)
    done = packing.sequences(packing.pack(docs, path, length=64), 64).collect()
    assert all(len(r.ids) == 64 for r in done) and sum(r.n_real for r in done) == len(flat)
    assert packing.pack(empty, path).count() == 0


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda d, m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda d, m: all(int(p) <= 255 for p in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda d, m: 16 <= len(d) <= 19 and pii.luhn(d)),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda d, m: 8 <= len(d) <= 15),
]


def test_pii_base_spans_are_those_of_the_plain_patterns():
    rng = random.Random(2)
    made = ["".join(rng.choice("ab@.1234 -+()%é") for _ in range(80)) for _ in range(1500)]
    made += ["a@b@c.de@f.g", "4111 1111 1111 1111 and 4111-1111-1111-1112", "1.2.3.4.5.6.7.8 300.1.1.1", "é a@b.co"]
    context = pii.context_sets(pii.CONTEXT_WORDS)
    for text in made:
        wanted = [
            (kind, m.start(), m.end())
            for kind, pattern, ok in BASE
            for m in re.finditer(pattern, text)
            if ok(re.sub("[^0-9]", "", m[0]), m[0])
        ]
        found = pii.find_spans(text, context, 0.6)
        assert [(s["kind"], s["start"], s["end"]) for s in found if s["kind"] in pii.BASE_KINDS] == wanted


def test_pii_checks_and_context(spark, docs, empty):
    context = pii.context_sets(pii.CONTEXT_WORDS)
    find = lambda t: [s["kind"] for s in pii.find_spans(t, context, 0.6)]
    assert "iban" in find("GB82 WEST 1234 5698 7654 32") and "iban" not in find("GB83 WEST 1234 5698 7654 32")
    assert find("my ssn is 123-45-6789") == ["ssn"] and find("part 123-45-6789") == []
    assert find("account 123456789") == ["account"] and find("number 123456789") == []
    assert find("x" * 200_000 + "@" + "1" * 200_000) == []
    rows = spark.createDataFrame([(1, "mail a@b.co or +1 (555) 010-9999", "en", 0.0, "9")], DOCS)
    rows = rows.withColumn("n_chars", F.length("text"))
    out = pii.redact(rows, length_col="n_chars").collect()[0]
    assert out.text == "mail [EMAIL] or [PHONE]" and out.n_chars == len(out.text) and out.score == 0.0
    assert pii.find_pii(docs).count() == docs.count() and pii.find_pii(empty).count() == 0
    assert pii.redact(empty).columns == empty.columns


def brute_fingerprint(text, width=4, seed=42):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    runs = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    h = [xxhash.xxh64(r.encode(), seed=seed).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(values, linked):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def test_simhash(docs, texts, empty):
    rows = simhash.near_duplicates(docs).collect()
    prints = [brute_fingerprint(t[1]) for t in texts]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    wanted = []
    for t, p, r in zip(texts, prints, roots):
        ids = [u[0] for u, s in zip(texts, roots) if s == r and u[0] is not None]
        wanted.append((t[0], f"{p:016x}", min(ids, default=None)))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == Counter(wanted)
    assert sum(r.stays for r in rows) == len(set(roots))
    assert simhash.drop_near_duplicates(docs).count() == len(set(roots))
    assert simhash.drop_near_duplicates(docs).columns == docs.columns
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("cell_rows", [8, 1 << 13])
def test_range_join_connects_what_all_pairs_would(spark, cell_rows):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(20)]
    near = {base[0]}
    while len(near) < 150:  # one crowded group
        near.add(rng.choice(sorted(near)) ^ (1 << rng.randrange(64)))
    for x in base[1:]:
        bits = rng.sample(range(64), 9)
        near |= {x, x ^ sum(1 << b for b in bits[:4]), x ^ sum(1 << b for b in bits[4:])}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in near)
    fps = spark.createDataFrame([(v,) for v in values], "fp bigint")
    found = components.components(simhash.near_links(fps, cell_rows=cell_rows)).collect()
    root = {r.node: r.root for r in found}
    mask = (1 << 64) - 1
    brute = brute_components(values, lambda a, b: ((a ^ b) & mask).bit_count() <= 4)
    assert [root.get(v, v) for v in values] == [values[r] for r in brute]


def brute_hits(texts, items, window):
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    windows = {}
    for item, text in items:
        w = pattern.findall((text or "").translate(LOWER))
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add("" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, names = pattern.findall((text or "").translate(LOWER)), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        out.append((len(w), len(hit), tuple(sorted(names))))
    return out


@pytest.mark.parametrize("block_words", [1 << 20, 40])
def test_decontamination(spark, docs, texts, empty, block_words):
    body = re.split(r"\s+", texts[0][1])
    long = re.split(r"\s+", texts[9][1])
    items = [
        (1, " ".join(body[5:30])), (2, " ".join(body[5:16])), (3, " ".join(long[100:140])), (3, "one"),
        (4, None), (5, ""), (None, " ".join(long[500:503])), (10, "nothing of this kind is there at all in any text"),
        (11, " ".join(long[700:720]).upper()),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.contamination(docs, bench, block_words=block_words).collect()
    wanted = Counter((t[0], *b) for t, b in zip(texts, brute_hits([t[1] for t in texts], items, 10)))
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in rows) == wanted
    assert max(r.longest for r in rows) >= 40
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.count() == sum(n for k, n in wanted.items() if not k[2]) and clean.columns == docs.columns
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_sentence_spans(spark, docs, empty):
    passage = "Here is a first line of ten words or so. Then comes another one that is long enough too. And a third."
    other = "Nothing else is like this sentence at all. Short one."
    rows = [
        (1, f"{other} {passage} The end of it."), (2, f"It starts in another way then {passage} And goes on."),
        (3, other), (4, None), (5, ""), (6, f"{passage}\n{passage}"), (None, "no stop"),
    ]
    out = sentence_spans.drop_repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string"))
    by = {r.doc_id: r for r in out.collect()}
    assert by[1].text == rows[0][1] and by[1].n_removed == 0
    assert "Then comes another" not in by[2].text and by[2].text.startswith("It starts") and by[2].first_docs == [1]
    assert by[6].n_removed >= 4 and by[3].n_removed == 0 and by[4].text is None and by[5].text == ""
    assert by[None].text == "no stop"
    rows = sentence_spans.drop_repeated_spans(docs).collect()
    assert len(rows) == docs.count() and sentence_spans.drop_repeated_spans(empty).count() == 0
    copies = [r for r in rows if r.doc_id == 2]
    assert copies[0].n_removed == copies[1].n_removed == 0  # equal rows are one document
    assert next(r for r in rows if r.doc_id == 5).n_removed > 0


def test_brown_scores(docs, texts, empty):
    rows = brown.score_texts(docs, fold("doc_id", 5) != 1, frequent=20, clustered=12, classes=4, rounds=3).collect()
    words = {i: [*re.findall("[^\x20\x09-\x0d]+", (t[1] or "").translate(LOWER)), None] for i, t in enumerate(texts)}
    learned = [i for i, t in enumerate(texts) if zlib.crc32(("" if t[0] is None else str(t[0])).encode()) % 5 != 1]
    c = Counter(w for i in learned for w in words[i])
    n, v = sum(c.values()), len(c)
    wanted = Counter()
    for i, t in enumerate(texts):
        base = sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words[i])
        wanted[(t[0], len(words[i]), sum(c[w] > 0 for w in words[i]), n, round(base, 6))] += 1
    got = Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == wanted and all(r.score < 0 for r in rows)
    assert brown.score_texts(empty, F.lit(True)).count() == 0
    assert all(r.base_score == 0 for r in brown.score_texts(docs, F.lit(False)).collect() if r.n_tokens == 1)


def test_class_gains_are_the_change_of_the_likelihood():
    rng = np.random.default_rng(4)
    words, k = 12, 4
    n = rng.integers(0, 6, (words, words)).astype(float)
    of = rng.integers(0, k, words)

    def value(of):
        pairs = np.zeros((k, k))
        np.add.at(pairs, (of[:, None].repeat(words, 1), of[None, :].repeat(words, 0)), n)
        return pairs, float(brown.xlogx(pairs).sum() - 2 * brown.xlogx(pairs.sum(0)).sum())

    n = (n + n.T) / 2  # as many before as after, as in running text
    pairs, now = value(of)
    for w in range(words):
        rest = np.arange(words) != w
        after = np.bincount(of[rest], n[w][rest], k)
        before = np.bincount(of[rest], n[:, w][rest], k)
        gain = brown.class_gains(after, before, n[w, w], of[w], pairs, pairs.sum(0), n[:, w].sum())
        for to in range(k):
            moved = of.copy()
            moved[w] = to
            assert gain[to] == pytest.approx(value(moved)[1] - now, abs=1e-9)


def test_language(spark, docs, empty):
    rng = random.Random(6)
    stock = {"xx": "aba cadab", "yy": "zozu wup", "zz": "éèê mné"}
    rows = [(i, "".join(rng.choice(stock[g]) for _ in range(60)), g, 0.0, "") for i, g in enumerate(list(stock) * 60)]
    rows += [(900, None, "xx", None, None), (901, "12 34 !", "yy", None, None), (902, "", None, None, None)]
    given = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in language.identify(given, fold("doc_id", 4) != 2).collect()}
    held = [r for r in rows[:-3] if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert np.mean([out[r[0]].lang_pred == r[2] for r in held]) > 0.95
    assert all(out[i].lang_pred == "und" and out[i].score == 0 for i in (900, 901, 902))
    assert all(0 <= r.score <= 1 for r in out.values())
    assert {r.lang_pred for r in language.identify(docs, F.lit(False)).collect()} == {"und"}
    assert language.identify(empty, F.lit(True)).count() == 0


def test_toxicity(spark, docs, empty):
    rng = random.Random(7)
    plain = [f"word{i}" for i in range(300)]
    rows, marks = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = rng.sample(plain, 30) + rng.sample(["nasty", "vilest", "rottener", "rottenish"], 2) * bad
        rng.shuffle(words)
        rows.append((i, " ".join(words), "en", 0.0, ""))
        marks.append((i, int(bad), "x"))
    rows += [(900, None, None, None, None), (901, "", "en", None, None)]
    marks += [(900, 0, ""), (None, 1, ""), (3, None, "")]
    given = spark.createDataFrame(rows, DOCS)
    labels = spark.createDataFrame(marks, "doc_id bigint, toxic int, text string")
    training = fold("doc_id", 5) != 0
    out = {r.doc_id: r.score for r in toxicity.score_toxicity(given, labels, training).collect()}
    held = [m for m in marks[:400] if zlib.crc32(str(m[0]).encode()) % 5 == 0]
    assert np.mean([(out[i] >= 0.5) == bool(t) for i, t, _ in held]) > 0.95
    assert out[900] < 0.5 and out[900] == out[901]
    kept = toxicity.drop_toxic(given, labels, training)
    assert kept.columns == given.columns and 290 <= kept.count() <= 310
    assert toxicity.score_toxicity(empty, labels, training).count() == 0
    assert {r.score for r in toxicity.score_toxicity(docs, labels.limit(0), training).collect()} == {0.0}


def test_nearest(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((600, 16))
    x[100:140] = x[100]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(700, None, 0), (750, [0.0] * 16, 0), (800, [float("nan")] * 16, 0), (None, x[0].tolist(), 0)]
    rows += [(850, [1.0, 2.0], 0), (900, [1.0, None] + [0.0] * 14, 0)]
    given = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank int")
    out = nearest.nearest(given, lambda i: i % 50 == 0, k=5).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    hits = 0
    for q in range(0, 600, 50):
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == [1, 2, 3, 4, 5] and q not in [r.vec_id for r in mine]
        near = unit @ unit[q]
        assert [r.score for r in mine] == pytest.approx([near[r.vec_id] for r in mine], abs=1e-12)
        wanted = sorted((i for i in range(600) if i != q), key=lambda i: (-round(near[i], 12), i))[:5]
        hits += len(set(wanted) & {r.vec_id for r in mine})
        if q == 100:
            assert [r.vec_id for r in mine] == [101, 102, 103, 104, 105]
    assert hits >= 0.9 * 60 and {r.query_id for r in out} == set(range(0, 600, 50))
    assert nearest.nearest(given.limit(0), lambda i: i % 50 == 0).count() == 0


def test_probes_come_in_order_of_their_score():
    place = np.array([0.2, 0.9, 0.5])
    found = probes = nearest.probes(place, 60)
    cost = lambda p: sum((k - x) ** 2 if k > 0 else (x - k - 1) ** 2 if k < 0 else 0 for k, x in zip(p, place))
    scores = [cost(p) for p in found]
    assert scores == sorted(scores) and len({tuple(p) for p in probes}) == 60


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    links += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    nodes = sorted({x for p in links for x in p if p[0] != p[1]})
    pairs = {frozenset(p) for p in links}
    brute = brute_components(nodes, lambda a, b: frozenset((a, b)) in pairs)
    assert {r.node: r.root for r in found} == {n: nodes[r] for n, r in zip(nodes, brute)}
    assert len(found) == len(nodes)


def test_spans_digest(spark, docs):
    from topicflow.llm.catalogue import joined_spans

    row = pii.find_pii(docs.where("doc_id = 12")).select(F.sha2(joined_spans(F.col("spans")), 256).alias("x")).first()
    assert row.x == hashlib.sha256(b"").hexdigest()
