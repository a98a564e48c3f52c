"""The stored full-text index gives what a scan of the texts gives."""

import random

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import search
from scriptorium.operators.fulltext import FullTextIndex


def scores(rows):
    return {r["chunk_id"]: round(r["fts_score"], 9) for r in rows.collect()}


def test_a_stored_index_scores_as_a_scan(spark, tmp_path):
    rng = random.Random(31)
    words = ["common"] * 20 + [f"w{i}" for i in range(40)] + ["été"]
    rows = [(f"c{i}", " ".join(rng.choices(words, k=rng.randrange(30)))) for i in range(200)] + [("n", None), ("e", "")]
    chunks = spark.createDataFrame(rows, "chunk_id string, text string").repartition(3)
    index = FullTextIndex(spark, str(tmp_path / "index"), buckets=8)
    with pytest.raises(ValueError):
        index.bm25("w1")
    index.refresh(chunks)
    for q in ("common w1 w2", "été", "w3 never", "never", "", "w5 W5"):
        assert scores(index.bm25(q)) == scores(search.bm25(chunks, q)), q
        assert [tuple(r)[0] for r in index.topk(q, 7).collect()] == [r[0] for r in search.fts_topk(chunks, q, 7).collect()]
    plan = index.bm25("w1 w2")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    vectors = chunks.withColumn("embedding", F.array(F.lit(1.0), F.pmod(F.crc32("chunk_id"), F.lit(100)).cast("double")))
    assert search.hybrid_topk(vectors, "common w1", [1.0, 5.0], 8, index).collect() == search.hybrid_topk(vectors, "common w1", [1.0, 5.0], 8).collect()
    index.refresh(chunks.where("chunk_id < 'c5'"))
    assert scores(index.bm25("common")) == scores(search.bm25(chunks.where("chunk_id < 'c5'"), "common"))
    assert index.refresh(chunks.limit(0)).bm25("common").collect() == []
