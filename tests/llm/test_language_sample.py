"""A rare language among six is learned and found."""

import random

from pyspark.sql import functions as F

from topicflow.llm import language

SYLLABLES = ["ba be bo", "ki ke ku", "mor mir mur", "sha she shi", "tol tul tel", "vax vex vox"]


def text(lang, seed):
    rng, parts = random.Random(seed), SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(3)) for _ in range(20))


def test_a_rare_language_among_six(spark):
    rows = [(6000 * k + i, text(k, 6000 * k + i), f"l{k}") for k in range(5) for i in range(1500)]
    rows += [(90_000 + i, text(5, 90_000 + i), "rare") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = language.identify(docs, F.col("doc_id") % 3 != 0, sample=300)
    out = out.withColumn("wanted", F.expr("CASE WHEN doc_id >= 90000 THEN 'rare' ELSE concat('l', doc_id div 6000) END"))
    right = {r.wanted: r.share for r in out.groupBy("wanted").agg(F.avg(F.expr("CAST(lang_pred = wanted AS int)")).alias("share")).collect()}
    assert len(right) == 6 and min(right.values()) > 0.9, right


def test_a_language_of_one_text_is_learned_from(spark):
    rows = [(i, text(i % 2, i), f"l{i % 2}") for i in range(400)] + [(1000, text(5, 1), "rare")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = language.identify(docs, F.lit(True), sample=300).where("doc_id = 1000").first()
    assert out.lang_pred == "rare"
