"""A query per operator of this folder over its whole table, with SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.llm import ball_tree, bpe, brown, decontaminate, language, nearest, packing, phrases
from topicflow.llm import pii, sentence_spans, simhash, token_files, toxicity
from topicflow.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_files.encode_and_read(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query
def op4_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, path, end_id=2, length=4096, with_ids=False)


@query
def op9_decontaminate(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.contamination(docs, items, window=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "longest",
    )


def joined_spans(spans):
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.concat_ws(",", one)


@query
def op3_pii(spark, sf_dir):
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [
        (F.size("spans") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}")
        for k in pii.BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


@query
def op6_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, width=4, seed=42, distance=4)
    return found.select("doc_id", "fingerprint", "component_id")


@query
def op10_sentence_spans(spark, sf_dir):
    return sentence_spans.drop_repeated_spans(table(spark, sf_dir, "documents"))


@query
def op5_brown_scores(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 1
    scores = brown.score_texts(docs, ~held_out)
    return scores.withColumn("held_out", fold("doc_id", 5) == 1)


@query
def op1_nearest(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, lambda vec_id: vec_id % 50 == 0, k=5)


@query
def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    return language.identify(docs, ~held_out).withColumn("held_out", held_out)


@query
def op8_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 5) == 0
    scores = toxicity.score_toxicity(docs, labels, ~held_out)
    return scores.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query
def op11_ball_tree(spark, sf_dir):
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return ball_tree.search_lexical(docs, items, k=20)


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op11_ball_tree"] = f"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
), sized AS (SELECT r, doc_id, words, len(words) AS n FROM doc WHERE len(words) > 0),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sized),
item AS (
  SELECT row_number() OVER () AS i, item_id,
         regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM benchmark
), wanted AS (
  SELECT i, item_id, term, count(*) AS times
  FROM (SELECT i, item_id, unnest(words) AS term FROM item) GROUP BY ALL
), held AS (
  SELECT r, doc_id, n, term, count(*) AS tf
  FROM (SELECT r, doc_id, n, unnest(words) AS term FROM sized)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term
), scored AS (
  SELECT i, item_id, r, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length)))) AS BIGINT)
           AS score
  FROM wanted JOIN held USING (term) JOIN weight USING (term), corpus
  GROUP BY i, item_id, r, doc_id
), ranked AS (
  SELECT item_id, doc_id, score,
         CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query
def op12_phrases(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), longest=5, at_least=100, first=2000)


ORACLES["op12_phrases"] = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS words FROM piece),
place AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM split),
run AS (SELECT lang, words, i, unnest(range(1, least(5, len(words) - i + 1) + 1)) AS size FROM place),
counted AS (
  SELECT lang, size, array_to_string(list_slice(words, i, i + size - 1), ' ') AS phrase, count(*) AS f
  FROM run GROUP BY ALL
), total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE size = 1 GROUP BY lang),
often AS (SELECT lang, size, phrase, string_split(phrase, ' ') AS words, f FROM counted WHERE f >= 100),
cut AS (
  SELECT lang, phrase, f AS a, k, array_to_string(words[:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM often WHERE size > 1)
), scored AS (
  SELECT cut.lang, cut.phrase, a, k, h.f AS l, t.f AS r, n,
         CAST((CAST(1000 AS HUGEINT) * a * n) // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM cut JOIN often h ON h.lang = cut.lang AND h.phrase = head
           JOIN often t ON t.lang = cut.lang AND t.phrase = tail JOIN total ON total.lang = cut.lang
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT *, unnest(range(1, size - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, size)) AS m FROM often WHERE size > 2)) GROUP BY ALL
), kept AS (
  SELECT worst.* FROM worst LEFT JOIN inside USING (lang, phrase) WHERE inside.f IS NULL OR inside.f < a
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
         phrase, a, l, r, n, score
  FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


@query
def op13_bpe(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    back = bpe.encode_and_decode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    numbers = F.array_join(F.col("ids").cast("array<string>"), " ")
    return back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.octet_length("text").cast("long").alias("text_bytes"),
    )
