"""Search kernels: exact vector top-k, BM25 full text, hybrid, and the list of hits they give.

Chunks need columns chunk_id, text and (for vectors) embedding. BM25: idf = ln(1 + (N - df + 0.5) / (df + 0.5)),
k1 = 1.2, b = 0.75, tokens are runs of letters and digits in lower case, no stemming. Query terms are literals,
so only matching tokens are grouped; corpus statistics are one aggregate row.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from scriptorium.functions import vectors as V
from scriptorium.functions.constants import STOP_WORDS

K1, B, RRF_K = 1.2, 0.75, 60
PLACES = 12
TOKEN = r"[\p{L}\p{N}]+"
#: The one letter whose lower case is two code points, the second of which would end the token.
DOTTED = ("\u0130", "i")


def query_terms(query: str, stop_words=STOP_WORDS) -> list[str]:
    return [t for t in dict.fromkeys(re.findall(r"[^\W_]+", query.replace(*DOTTED).lower())) if t not in stop_words]


def tokens(text):
    return F.regexp_extract_all(F.lower(F.replace(text, *map(F.lit, DOTTED))), F.lit(TOKEN), F.lit(0))


def postings(chunks: DataFrame) -> DataFrame:
    """The inverted index: rows (term, chunk_id, tf)."""
    return chunks.select("chunk_id", F.explode(tokens(F.col("text"))).alias("term")).groupBy("term", "chunk_id").agg(F.count("*").alias("tf"))


def bm25(chunks: DataFrame, query: str) -> DataFrame:
    """Rows (chunk_id, fts_score) of the chunks that hold a query term."""
    terms = query_terms(query)
    sized = chunks.select("chunk_id", tokens(F.col("text")).alias("t"))
    counts = [F.size(F.filter("t", _equals(term))).alias(f"tf{i}") for i, term in enumerate(terms)]
    measured = sized.select("chunk_id", F.array_size("t").alias("dl"), *counts)  # a null text has no length, with ANSI mode or without
    stats = measured.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    joined = measured.crossJoin(F.broadcast(stats))  # one row of statistics
    score = F.lit(0.0)
    for i in range(len(terms)):
        tf, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5))
        score = score + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))).otherwise(0.0)
    return joined.select("chunk_id", score.alias("fts_score")).where("fts_score > 0")


def _equals(term: str):
    return lambda t: t == term


def best_first():
    """The order of full-text scores; those that differ only by the rounding of sums are ties."""
    return F.desc(F.round("fts_score", PLACES))


def nearest_first():
    """The order of distances; chunks without a vector come last."""
    return F.asc_nulls_last("distance")


def fts_topk(chunks: DataFrame, query: str, k: int) -> DataFrame:
    """Rows (chunk_id, fts_score) of the k best, ties by id."""
    return bm25(chunks, query).orderBy(best_first(), "chunk_id").limit(k)


def vector_topk(chunks: DataFrame, vector: list[float], k: int) -> DataFrame:
    """Rows (chunk_id, distance) of the k nearest by squared distance, ties by id; an exact scan."""
    near = chunks.select("chunk_id", V.squared_l2(F.col("embedding"), V.literal(vector)).alias("distance"))
    return near.orderBy(nearest_first(), "chunk_id").limit(k)


def ranked(rows: DataFrame, *order) -> DataFrame:
    """A one-based rank over a list that a top-k has already bounded."""
    return rows.withColumn("rank", F.row_number().over(W.orderBy(*order)))


def hybrid_topk(chunks: DataFrame, query: str, vector: list[float], k: int, index=None) -> DataFrame:
    """Rows (chunk_id, relevance_score, distance, fts_score): reciprocal ranks of both lists summed.

    Ties go to rows of the vector list, then to the better rank, then to the lesser id. With a stored index over
    the same chunks, the full-text list comes from it.
    """
    near = ranked(vector_topk(chunks, vector, k), nearest_first(), "chunk_id").select("chunk_id", F.lit(0).alias("list"), "rank", "distance", F.lit(None).cast("double").alias("fts_score"))
    text = ranked(index.topk(query, k) if index else fts_topk(chunks, query, k), best_first(), "chunk_id").select("chunk_id", F.lit(1).alias("list"), "rank", F.lit(None).cast("double").alias("distance"), "fts_score")
    fused = near.unionByName(text).groupBy("chunk_id").agg(
        F.round(F.sum(1.0 / (RRF_K + F.col("rank"))), 12).alias("relevance_score"), F.max("distance").alias("distance"), F.max("fts_score").alias("fts_score"),
        F.min("list").alias("list"), F.min("rank").alias("rank"))
    best = fused.orderBy(F.desc("relevance_score"), "list", "rank", "chunk_id").limit(k)
    return ranked(best, F.desc("relevance_score"), "list", "rank", "chunk_id").drop("list")


def hits(rows: DataFrame, key: str, kind: str, min_relevance: float | None = None) -> DataFrame:
    """A result list in the common shape; a relevance cut-off affects only lists that have relevance."""
    for name in ("relevance_score", "distance", "fts_score"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("double"))
    if min_relevance is not None:
        rows = rows.where(F.col("relevance_score").isNull() | (F.col("relevance_score") >= min_relevance))
    if "rank" not in rows.columns:
        rows = ranked(rows, *([best_first(), "chunk_id"] if kind == "fts" else [nearest_first(), "chunk_id"]))
    return rows.select("chunk_id", F.lit(key).alias("retrieval_key"), F.lit(kind).alias("retrieval_kind"), "rank", "relevance_score", "distance", "fts_score")
