"""The whole query: variants by mode, searches, exclusions, fusion, order, batches."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.operators import filters, fusion, models, search

#: Searches of the question itself that each mode makes; full adds rewordings and a hypothetical answer.
SEARCHES = {"full": ("hybrid", "fts"), "fts_hybrid": ("hybrid", "fts"), "hybrid_only": ("hybrid",), "fts_only": ("fts",), "vector_only": ("vector",)}
SHORT = {"hybrid": "hybrid_only", "fts": "fts_only", "vector": "vector_only"}
MODES = (*SEARCHES, *SHORT)


@dataclass(frozen=True)
class QueryRequest:
    query: str
    mode: str = "full"
    depth: int = 10
    final_top_k: int = 15
    batch_size: int = 5
    rewrite_count: int = 2
    rrf_k: int = 60
    min_lists: int = 1
    min_relevance: float | None = None
    candidate_pool_k: int | None = None
    hyde: bool = True
    filters: filters.QueryFilters = field(default_factory=filters.QueryFilters)


def variants(request: QueryRequest) -> list[tuple[str, str, str]]:
    """(key, kind, text) of each search that the mode asks for."""
    if request.mode not in MODES:
        raise ValueError(f"unknown mode: {request.mode}")
    mode = SHORT.get(request.mode, request.mode)
    out = [(f"original_{kind}", kind, request.query) for kind in SEARCHES[mode]]
    if mode != "full":
        return out
    out += [(f"rewrite_{i}_vector", "vector", t) for i, t in enumerate(models.rewrites(request.query, request.rewrite_count), 1)]
    return out + ([("hyde_vector", "vector", models.hypothetical_answer(request.query))] if request.hyde else [])


def retrieve(chunks: DataFrame, request: QueryRequest, embedder: models.Embedder, seen_chunks: DataFrame | None = None, seen_papers: DataFrame | None = None) -> DataFrame:
    """The union of all lists, without excluded chunks and papers."""
    own = filters.apply(chunks, request.filters)
    k = request.candidate_pool_k or request.depth
    parts = []
    for seq, (key, kind, text) in enumerate(variants(request)):
        vector = embedder.embed([text])[0] if kind != "fts" else None
        rows = {"hybrid": lambda: search.hybrid_topk(own, text, vector, k), "fts": lambda: search.fts_topk(own, text, k), "vector": lambda: search.vector_topk(own, vector, k)}[kind]()
        parts.append(search.hits(rows, key, kind, request.min_relevance).withColumn("hit_seq", F.struct(F.lit(seq).alias("v"), F.col("rank").alias("r"))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if seen_papers is not None:
        out = out.join(chunks.select("chunk_id", "paper_id"), "chunk_id")
    return filters.exclude(out, seen_chunks, seen_papers)


def run(chunks: DataFrame, request: QueryRequest, embedder: models.Embedder, **seen) -> DataFrame:
    """The fused chunks with their columns, rank and batch."""
    fused = fusion.fuse(retrieve(chunks, request, embedder, **seen), 1 << 30, request.rrf_k, request.min_lists)
    best = fusion.final_order(fused, chunks, request.final_top_k)
    return fusion.batches(best, request.batch_size, F.desc("rrf_score"), "paper_id", "chunk_index")
