"""A batch of texts gives the ids of each text, and every new word goes to the model once."""

import random

import public_tokenizers
import pyarrow as pa
import pytest

from topicflow.llm import tokens

TEXTS = [
    "One two### two. two, two### one_two's Straße*** straße!! !'s (x) a\nb ###\nb###", "", "a  b\n\n c ", "\0 two \0a",
    "two###' two'### it's!! it!'s É### é.́ Σας### x²$$$ 12### <|endoftext|> two<|endoftext|>", "\n", "two \n two", " ",
    "tab\ttwo###   two###\x85two\xa0",
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_batch_gives_the_ids_of_each_text(name):
    code, rng = tokens.Encoder(public_tokenizers.path(name)), random.Random(2)
    mixed = ["".join(rng.choice("aB é.,'’\n\t  7ßΣ#_!&\0") for _ in range(rng.randrange(70))) for _ in range(2000)]
    for kind in (pa.string(), pa.large_string()):  # the second time from memory
        assert code.encode(pa.array(TEXTS + mixed, kind)) == code.whole(TEXTS + mixed)
    assert code.encode([]) == []


def test_words_with_stops_reach_the_model_once(monkeypatch):
    code = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    asked, model, whole = [], code.model_ids, []
    monkeypatch.setattr(code, "model_ids", lambda words: asked.extend(words) or model(words))
    library = code.whole
    monkeypatch.setattr(code, "whole", lambda texts: whole.extend(texts) or library(texts))
    code.encode(["x zebra zebra### zebra. zebra", "x zebra***"])
    code.encode(["x zebra!!", "x zebra,"])
    assert asked.count(code.letters[32] + "zebra") == 1
    assert sorted(whole) == sorted(["###", ".", "***", "!!", ","])
