"""Kept pieces are held as arrays, not as objects."""

import random
import tracemalloc

import public_tokenizers
import pyarrow as pa

from topicflow.llm import tokens


def test_kept_words_take_little_memory():
    rng = random.Random(5)
    code = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    words = {"".join(rng.choices("abcdefghij", k=9)) for _ in range(20_000)}
    texts = pa.array([" ".join(words)])
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
        code.encode(texts)
        taken = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert len(code.known) > len(words) and taken < 64 * len(words)
