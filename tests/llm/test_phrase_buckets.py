"""Rare phrases stay out of the full count, and none that is frequent does."""

import random
from collections import Counter

import numpy as np
import pytest

from topicflow.llm import phrases

RNG = random.Random(11)
WORDS = ["".join(RNG.choices("abcdefgh", k=4)) for _ in range(120)]
TEXTS = [" ".join(RNG.choices(WORDS, k=60)) + " so it goes on" for _ in range(200)]


def pairs_and_words() -> Counter:
    found = Counter()
    for text in TEXTS:
        words = text.split()
        found.update(words)
        found.update(map(" ".join, zip(words, words[1:])))
    return found


@pytest.mark.parametrize("power", [16, 22])
def test_buckets_hold_every_frequent_phrase_and_few_others(spark, power):
    docs = spark.createDataFrame([("en", t) for t in TEXTS], "lang string, text string").repartition(4)
    full = phrases.Filter(np.full(1 << 13, 255, np.uint8), 16)
    heavy = phrases.heavy_buckets(docs, 2, full, 30, power)
    wanted = {p: n for p, n in pairs_and_words().items() if n >= 30}
    sent = phrases.counted(docs, 2, full, heavy=heavy).where("words > 0").collect()
    assert {r.phrase: r.n for r in sent if r.n >= 30} == wanted
    assert len(sent) < 1.2 * len(wanted) < 0.1 * len(pairs_and_words())


def test_the_full_pass_leaves_rare_phrases_out(spark, monkeypatch):
    sizes, counted = [], phrases.counted

    def watched(docs, *args, **more):
        found = counted(docs, *args, **more)
        sizes.append(found.count())
        return found

    monkeypatch.setattr(phrases, "counted", watched)
    docs = spark.createDataFrame([("en", t) for t in TEXTS], "lang string, text string")
    frequent = phrases.frequent_phrases(docs, 2, 30, sample=1.0).where("words > 0").collect()
    assert {r.phrase: r.n for r in frequent} == {p: n for p, n in pairs_and_words().items() if n >= 30}
    # the passes over the sample come first
    assert sizes[2] < 0.1 * len(pairs_and_words())
