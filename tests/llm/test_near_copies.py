"""Near copies by shingle similarity against brute force over all pairs."""

import random

import corpus_pipeline
import numpy as np
import pytest

from topicflow.llm import near_copies


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def jaccard(a, b):
    a, b = (set(near_copies.shingle_set(x or "", 5).tolist()) for x in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    out = [(i, " ".join(words(rng, 200))) for i in range(40)]
    for i in range(30):  # near copies at about 0.8 to 0.95, and some below
        text = out[i][1].split()
        for k in rng.sample(range(200), 1 + i % 6):
            text[k] = "changed"
        out.append((100 + i, " ".join(text)))
    base = words(rng, 300)
    for i in range(60):  # one family, whose members are not all near to each other
        text = list(base)
        for k in rng.sample(range(300), 2 + i % 6):
            text[k] = f"own{i}"
        out.append((300 + i, " ".join(text)))
    rng.shuffle(out)
    return [*out, (None, out[0][1]), (900, None), (901, ""), (902, "two words"), (903, "TWO words")]


def expected(rows):
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if jaccard(rows[i][1], rows[j][1]) >= 0.8:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        place = (doc_id is None, doc_id or 0)
        least[find(i)] = min(least.get(find(i), place), place)
    return sorted(None if gone else x for gone, x in least.values())


def test_stage_drops_near_copies(spark, rows):
    at = [jaccard(a[1], b[1]) for a in rows for b in rows if a[0] and b[0] and a[0] < 40 and b[0] == a[0] + 100]
    assert sum(0.8 <= x < 0.95 for x in at) >= 5
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == expected(rows)
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


@pytest.mark.parametrize("part_rows", [4, 1 << 9])
def test_buckets_whose_members_are_not_near_the_smallest(spark, part_rows):
    # one bucket for all: only the full comparison links those that the smallest is not near to
    rng = random.Random(5)
    texts = []
    for _ in range(7):
        body = words(rng, 100)
        texts += [" ".join(body), " ".join([*body[:-2], "x", "y"])]
    sets = [near_copies.shingle_set(t, 5) for t in texts]
    ids = [near_copies.set_id(s) for s in sets]
    classes = spark.createDataFrame([(s, i, [1]) for i, s in enumerate(ids)], "set bigint, at bigint, bands array<bigint>")
    frame = spark.createDataFrame(list(enumerate(texts)), "row bigint, text string")
    links = near_copies.near_links(classes, frame, 5, 0.8, part_rows).collect()
    assert {frozenset((r.a, r.b)) for r in links} == {frozenset(ids[i : i + 2]) for i in range(0, 14, 2)}


def test_band_keys_find_pairs_at_the_limit():
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 64, 450, np.uint64))
        b = np.unique(np.concatenate([a[rng.permutation(len(a))[:400]], rng.integers(0, 1 << 64, 50, np.uint64)]))
        assert abs(len(np.intersect1d(a, b)) / len(np.union1d(a, b)) - 0.8) < 0.01
        missed += not (near_copies.band_keys(a) == near_copies.band_keys(b)).any()
    assert missed == 0


def test_fingerprints_propose_candidates_without_band_keys(spark):
    # no two share a band key, so only the round of fingerprints can link the near copies
    rng = random.Random(8)
    texts = []
    for i in range(6):
        body = words(rng, 3000)
        texts += [" ".join(body), " ".join([*body[:-2], f"x{i}", "y"])]
    sets = [near_copies.shingle_set(t, 5) for t in texts]
    ids = [near_copies.set_id(s) for s in sets]
    prints = [near_copies.fingerprint(s) for s in sets]
    schema = "set bigint, at bigint, fp bigint, bands array<bigint>"
    classes = spark.createDataFrame([(s, i, prints[i], [i]) for i, s in enumerate(ids)], schema)
    frame = spark.createDataFrame(list(enumerate(texts)), "row bigint, text string")
    keys = near_copies.fingerprint_keys(classes.select("set", "fp"))
    links = near_copies.near_links(classes, frame, 5, 0.8, prints=keys).collect()
    bits = [((prints[i] ^ prints[i + 1]) & (1 << 64) - 1).bit_count() for i in range(0, 12, 2)]
    near = {frozenset(ids[2 * i : 2 * i + 2]) for i, n in enumerate(bits) if n <= near_copies.DISTANCE}
    assert len(near) >= 4
    assert {frozenset((r.a, r.b)) for r in links} == near


def test_the_stage_links_by_the_range_join(spark, rows, monkeypatch):
    seen, join = [], near_copies.simhash.near_links
    monkeypatch.setattr(near_copies.simhash, "near_links", lambda fps, *a: seen.append(fps.count()) or join(fps, *a))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == expected(rows)
    assert len(seen) == 1 and seen[0] > 100
