"""Pieces that a process has met stay known when the newer generation is full."""

import public_tokenizers

from topicflow.llm import tokens


def test_a_full_generation_is_kept_as_the_older_one(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    code = tokens.Encoder(path)
    asked, word = [], code.word
    monkeypatch.setattr(code, "word", lambda piece: asked.append(piece) or word(piece))
    texts = ["alpha beta gamma delta", "epsilon zeta", "alpha beta.", "epsilon", "eta theta iota kappa", "alpha"]
    plain = [code.library.encode(t, add_special_tokens=False).ids for t in texts]
    for text, ids in zip(texts, plain):
        (found,) = code.encode([text])
        assert list(memoryview(found).cast("H")) == ids
    assert asked.count("alpha") == 1 and len(code.known) + len(code.older) <= 16
    code.encode(["one two three four five", "six seven eight nine ten"])
    code.encode(["eleven twelve thirteen fourteen"])
    assert "epsilon" not in code.known | code.older
