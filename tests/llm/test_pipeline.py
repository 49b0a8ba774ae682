"""The pipeline stage by stage against plain Python on a small folder of tables."""

import random
import re

import corpus_pipeline
import pytest
from topicflow.llm import simhash
from topicflow.llm.common import fold


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    words = [f"{a}{b}" for a in ("ba", "do", "ki", "mu", "ne") for b in ("la", "ro", "si", "tu", "va", "za")]

    def text(seed, n=60, extra=()):
        rng = random.Random(seed)
        return " ".join([*[rng.choice(words) + str(rng.randrange(40)) for _ in range(n)], *extra])

    rows = [(i, text(i, extra=["vilest", "nasty"] if i % 4 == 0 else []), "en", "s", 0) for i in range(160)]
    bench = text(901)
    rows += [
        (200, text(500), "en", "s", 1), (201, text(500), "en", "s", 1), (201, text(500), "en", "s", 1),
        (202, bench + " tail", "en", "s", 1), (203, "write to a.b@c.org now " + text(502), None, None, 1),
        (204, None, None, None, None), (205, "", "en", "s", 0), (None, text(503), "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{at}/documents.parquet")
    labels = [(i, 1, int(i % 4 == 0)) for i in range(160)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([(1, bench)], "item_id bigint, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    toxic = [r.doc_id for r in seen["toxicity"]]
    assert not any("vilest" in (r.text or "") for r in seen["toxicity"])
    assert len(toxic) == 160 - 40 + 8
    kept = seen["simhash_near_dedup"]
    assert [r.doc_id for r in kept if r.doc_id in (200, 201)] == [200]
    # brute force: one row of each component of fingerprints at four bits or fewer
    prints = sorted({simhash.fingerprint(simhash.shingle_hashes(r.text or "", 5, 42)) for r in seen["toxicity"]})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
                root[find(a)] = find(b)
    assert len(kept) == len({find(p) for p in prints})
    ids = {r.doc_id for r in seen["decontamination"]}
    assert 202 not in ids and {r.doc_id for r in kept} - ids == {202}
    masked = {r.doc_id: r for r in seen["pii"]}
    assert masked[203].text.startswith("write to [EMAIL] now ") and masked[203].n_chars == len(masked[203].text)
    assert {r.doc_id for r in seen["packing"]} == set(masked)
    assert sum(len(re.findall(r"\S+", r.text or "")) >= 0 for r in seen["pii"]) == len(seen["pii"])


def test_run_gives_the_last_stage(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns[:3] == ["doc_id", "start", "length"]
    assert fold is not None
