"""Reciprocal rank fusion of result lists, summary batches and ordered text assembly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from scriptorium.functions.text import citation_label


#: Sums of reciprocal ranks are rounded, so that ties don't hang on the order of addition.
PLACES = 12


def fuse(hits: DataFrame, final_top_k: int, rrf_k: int = 60, min_lists: int = 1) -> DataFrame:
    """One row per chunk of the union of lists: score, lists, kinds, ranks and best scores.

    hits may have a column hit_seq for the order of hits; else rank and key order them. Chunks need min_lists
    distinct lists. Best first, then by chunk_id; callers that have paper_id and chunk_index can reorder.
    """
    if rrf_k <= 0 or min_lists <= 0:
        raise ValueError("rrf_k and min_lists must be positive")
    if "hit_seq" not in hits.columns:
        hits = hits.withColumn("hit_seq", F.struct("retrieval_key", "rank"))
    entry = F.array_sort(F.collect_list(F.struct("hit_seq", "retrieval_kind", "retrieval_key", "rank")))
    out = hits.groupBy("chunk_id").agg(
        F.round(F.sum(1.0 / (rrf_k + F.col("rank"))), PLACES).alias("rrf_score"), F.sort_array(F.collect_set("retrieval_key")).alias("retrieval_keys"), entry.alias("e"),
        F.max("relevance_score").alias("best_relevance"), F.min("distance").alias("best_distance"), F.max("fts_score").alias("best_fts"))
    out = out.where(F.size("retrieval_keys") >= min_lists)
    last = F.aggregate("e", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>")), lambda m, x: F.map_concat(
        F.map_filter(m, lambda k, _: k != x["retrieval_key"]), F.create_map(x["retrieval_key"], x["rank"].cast("int"))))
    out = out.select("chunk_id", "rrf_score", "retrieval_keys", F.transform("e", lambda x: x["retrieval_kind"]).alias("retrieval_kinds"), last.alias("contributing_ranks"),
                     "best_relevance", "best_distance", "best_fts")
    return out.orderBy(F.desc("rrf_score"), "chunk_id").limit(final_top_k)


def final_order(fused: DataFrame, chunks: DataFrame, final_top_k: int) -> DataFrame:
    """The fused list with its chunks' columns, by score, paper and place."""
    return fused.join(chunks, "chunk_id").orderBy(F.desc("rrf_score"), "paper_id", "chunk_index").limit(final_top_k)


def batches(ranked: DataFrame, size: int = 5, *order) -> DataFrame:
    """Consecutive groups of `size` of a bounded ranked list, from zero."""
    if size <= 0:
        raise ValueError("the batch size must be positive")
    return ranked.withColumn("position", F.row_number().over(W.orderBy(*order))).withColumn("batch_index", F.floor((F.col("position") - 1) / size).cast("int"))


def batch_prompts(batched: DataFrame) -> DataFrame:
    """One row per batch: its chunks as text with citation labels, in order, and the ids."""
    block = F.concat_ws("\n", F.concat(F.lit("Citation: ("), citation_label(F.col("authors"), F.col("year"), F.col("paper_id")), F.lit(")")),
                        F.concat(F.lit("Paper title: "), "paper_title"), F.concat(F.lit("Section title: "), "section_title"),
                        F.concat(F.lit("Chunk index: "), F.col("chunk_index").cast("string")), F.lit("Chunk text:"), "text")
    rows = F.array_sort(F.collect_list(F.struct("position", block.alias("block"), "chunk_id")))
    return batched.groupBy("batch_index").agg(rows.alias("r")).select(
        "batch_index", F.array_join(F.transform("r", lambda x: x["block"]), "\n\n").alias("prompt"), F.transform("r", lambda x: x["chunk_id"]).alias("chunk_ids"))
