"""Words beyond the clustered ones have classes too, and scores use them."""

import math

import numpy as np
from pyspark.sql import functions as F

from topicflow.llm import brown


def test_words_are_placed_by_their_neighbours():
    pairs = np.array([[1.0, 90, 5], [90, 1, 5], [5, 5, 0]])
    before = np.array([[3.0, 0, 0], [0, 3, 0]])
    assert brown.context_classes(before, before, pairs).tolist() == [1, 0]


def test_codes_of_a_word_are_joined_over_batches():
    import pyarrow as pa

    pairs = np.array([[1.0, 90, 5], [90, 1, 5], [5, 5, 0]])
    rows = [(b"a", bytes([0, 0])), (b"a", bytes([0, 0, 1, 1])), (b"b", bytes([1, 1]))]
    batches = [pa.RecordBatch.from_arrays([pa.array([w]), pa.array([c])], ["word", "codes"]) for w, c in rows]
    found = [r for b in brown.place_words(pairs)(iter(batches)) for r in b.to_pylist()]
    assert found == [{"word": b"a", "n": 3, "class": 1}, {"word": b"b", "n": 1, "class": 0}]


def test_rare_words_have_the_class_of_their_places(spark):
    """Nouns follow articles; a rare noun after an article is likelier than where a verb stands."""
    rows, verbs = [], ["runs", "sits", "eats"]
    for i in range(400):
        noun = f"noun{i % 40}" if i % 2 else ["dog", "cat"][i % 4 // 2]
        rows.append((i, f"the {noun} {verbs[i % 3]} and the {noun} {verbs[i % 3]}"))
    rows += [(1000, "the noun1 runs"), (1001, "noun1 the runs"), (1002, "the unheard runs")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = F.col("doc_id") < 1000
    how = {"clustered": 7, "classes": 4, "rounds": 9}
    whole = {r.doc_id: r for r in brown.score_texts(docs, train, **how).collect()}
    joined = {r.doc_id: r for r in brown.score_texts(docs, train, frequent=8, **how).collect()}
    assert whole[1000].score > whole[1001].score + 1
    assert whole[1000].n_known == 4 and whole[1002].n_known == 3
    for i in whole:  # the broadcast words change nothing
        assert math.isclose(whole[i].score, joined[i].score, rel_tol=1e-9)
        assert math.isclose(whole[i].base_score, joined[i].base_score, rel_tol=1e-9)
