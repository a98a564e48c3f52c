"""Corpus pipeline: toxicity, SimHash near-dedup, benchmark decontamination, secret scans, BPE encoding and
decoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet in the shared
folder and reads again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import bpe, decontaminate, secrets, simhash, toxicity
from scriptorium.llm.common import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learns from the labels of documents that aren't held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), lambda i: ~toxicity.held_out(i))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near-duplicates."""
    return simhash.dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def cover_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by marks; n_chars is that of the new text."""
    covered = secrets.redact(docs)
    return covered.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids, the number of tokens, and the digest of the text decoded from them."""
    encoded = bpe.with_ids(docs, out="token_ids", decoded="decoded")
    encoded = encoded.withColumn("n_tokens", (F.octet_length("token_ids") / 4).cast("long"))
    return encoded.withColumn("decoded_sha256", F.sha2(F.col("decoded").cast("binary"), 256)).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", cover_secrets),
    ("bpe encoding and decoding", encode),
]
#: Segment scores, fingerprint components and token ids can't be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; the result is read from the shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
