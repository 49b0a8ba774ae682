"""Rows are numbered once: a scan that is cut otherwise between two jobs changes nothing."""

import pytest

from topicflow.llm import decontaminate, simhash

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def docs(spark, tmp_path):
    rows = [(i, f"document {i} " + " ".join(f"w{i}x{k}" for k in range(40))) for i in range(60)]
    rows += [(100 + i, rows[3 * i][1]) for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").orderBy("doc_id")
    frame.coalesce(1).write.option("parquet.block.size", "2000").parquet(f"{tmp_path}/a")
    frame.coalesce(1).write.option("parquet.block.size", "2000").mode("append").parquet(f"{tmp_path}/a")
    return spark.read.parquet(f"{tmp_path}/a")


def changed_after(monkeypatch, spark, module, name):
    """The first job of the operator runs on one partition, all later ones on many."""
    before, real = spark.conf.get(SPLIT), getattr(module, name)

    def run(*args, **options):
        spark.conf.set(SPLIT, "1g")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        out = real(*args, **options)
        out = out.sparkSession.createDataFrame(out.collect(), out.schema)
        spark.conf.set(SPLIT, "1000")
        return out

    monkeypatch.setattr(module, name, run)
    yield
    spark.conf.set(SPLIT, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")
    spark.conf.unset("spark.sql.files.minPartitionNum")


def test_near_duplicates(spark, docs, monkeypatch):
    for _ in changed_after(monkeypatch, spark, simhash, "near_duplicates"):
        kept = sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect())
    assert kept == list(range(60))


def test_decontamination(spark, docs, monkeypatch):
    items = docs.where("doc_id IN (7, 31, 58)").selectExpr("doc_id AS item_id", "text").distinct()
    for _ in changed_after(monkeypatch, spark, decontaminate, "contamination"):
        kept = sorted(r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect())
    assert kept == sorted(2 * [i for i in [*range(60), *range(100, 120)] if i not in (7, 31, 58)])
