"""Retrieval over all documents, also those without a given vector."""

import random

from scriptorium.operators import models
from scriptorium.plans import catalog
from scriptorium.plans import reference_queries as R


def test_documents_without_a_vector_are_found(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(50)], k=30)) for _ in range(40)] + [None, "", R.QUESTION, R.ASKED]
    rows = [(i, t, "en", f"src{(i + 1) % 4}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, [1.0] * 4) for i in range(20)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    spark.createDataFrame([(0, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    chunks = {r["chunk_id"]: r["embedding"] for r in R.all_documents(spark, str(tmp_path)).collect()}
    assert len(chunks) == len(texts)
    for i, want in enumerate(models.HashEmbedder(R.WIDTH).embed([t or "" for t in texts])):
        assert all(abs(a - b) < 1e-12 for a, b in zip(chunks[str(i)], want, strict=True))
    best = catalog.QUERIES["hybrid_rrf_topk_all"](spark, str(tmp_path)).orderBy("rrf_score", ascending=False).first()
    assert best["chunk_id"] == "42" and best["retrieval_keys"] == "fts,hybrid,vector"
    full = catalog.QUERIES["query_full_all"](spark, str(tmp_path)).orderBy("position").first()
    assert full["chunk_id"] == "43" and full["position"] == 1
    for name in ("rrf_min_lists", "exclusions_deepen", "relevance_cutoff", "exclusions_expand", "summary_batches"):
        assert "42" in {r["chunk_id"] for r in catalog.QUERIES[f"{name}_all"](spark, str(tmp_path)).collect()}
