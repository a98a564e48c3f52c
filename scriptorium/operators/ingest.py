"""Ingestion: layout documents, Markdown or classified JSON to rows of the chunk table.

All stages are one lazy plan partitioned by paper; papers with unresolved labels are set apart, not raised.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions import vectors as V
from scriptorium.operators import blocks, chunking, labels, metadata
from scriptorium.sources import store

PAPER = "paper_id string, paper_title string, authors array<string>, journal string, volume string, issue string, year int, doi string, issn string, references array<string>, markdown_path string, marker_json_path string, pdf_path string"


@dataclass(frozen=True)
class Ingested:
    """Rows for the chunk table, papers kept back with the count of their unresolved chunks, papers' metadata issues."""

    rows: DataFrame
    kept_back: DataFrame
    issues: DataFrame


def classified_chunks(papers: DataFrame, min_words: int = 200, overlap: int = 50) -> DataFrame:
    """Labelled chunks of papers (paper_id, markdown): sections, word windows, labels carried forward."""
    parts = chunking.chunks(chunking.sections(papers), min_words, overlap)
    place = ["paper_id", "section_pos"]
    labelled = labels.label_sections(parts.groupBy(*place, "title", "heading_level").agg(F.count("*").alias("n_chunks")))
    reason = F.when(F.col("confidence") == "high", "title").when(F.col("label").isNotNull(), "carried forward").otherwise("unresolved")
    own = labelled.select(*place, "label", "source", "confidence", "needs_llm", F.lit(False).alias("used_context"), reason.alias("reason"))
    return parts.join(own, place)


def papers_of(found: DataFrame) -> DataFrame:
    """The table's paper columns of extracted metadata (doc_id, title, ..., source_path); a paper without title gets its id."""
    year = F.when(F.col("year").rlike(r"^\d+$"), F.col("year").try_cast("int"))
    text = F.lit(None).cast("string")
    return found.select(F.col("doc_id").alias("paper_id"), F.coalesce("title", "doc_id").alias("paper_title"), "authors", "journal", "volume", "issue", year.alias("year"), "doi", "issn", "references",
                        text.alias("markdown_path"), F.col("source_path").alias("marker_json_path"), text.alias("pdf_path"))


def table_rows(chunks: DataFrame, papers: DataFrame, dimension: int) -> DataFrame:
    """Chunks with their paper's columns, ids and hash embeddings, in the table's columns."""
    named = chunks.select("paper_id", F.col("title").alias("section_title"), "heading_level", "chunk_index", "text", "word_count", F.col("label").alias("classification_label"),
                          F.col("source").alias("classification_source"), F.col("confidence").alias("classification_confidence"), "used_context", "reason")
    return store.denormalize(named, papers).withColumn("embedding", V.hash_embedding(F.col("text"), dimension).cast("array<float>"))


def from_layout(layout: DataFrame, dimension: int = 256, min_words: int = 200, overlap: int = 50, overrides: DataFrame | None = None, keep_unresolved: bool = False) -> Ingested:
    """All layout documents (sources.store.read_layout): metadata, filtered Markdown, chunks, labels, rows.

    overrides repairs metadata; papers with an unresolved label are kept back unless keep_unresolved.
    """
    flat = blocks.flatten(layout)
    found = metadata.extract(flat)
    if overrides is not None:
        found = metadata.repaired(found, overrides)
    kept = blocks.flagged(flat, found).where("reason IS NULL")
    chunks = classified_chunks(blocks.markdown(kept).withColumnRenamed("doc_id", "paper_id"), min_words, overlap)
    kept_back = labels.unresolved_papers(chunks)
    papers = papers_of(found.join(layout.select("doc_id", "source_path"), "doc_id"))
    good = chunks if keep_unresolved else chunks.join(kept_back, "paper_id", "left_anti")
    return Ingested(table_rows(good, papers, dimension), kept_back, metadata.missing_fields(found).where(F.size("issues") > 0).select("doc_id", "issues"))


def from_classified(spark: SparkSession, path: str, dimension: int = 256, layout_path: str | None = None, paper_id: str | None = None, pdf_path: str | None = None) -> DataFrame:
    """Rows of classified JSON, with the metadata of the layout JSON if given; labels may be unresolved.

    The paper is named as given, else after the layout file, else after the classified file; its title is that
    of the metadata, else the name of the Markdown file, else its id.
    """
    chunks = store.read_classified(spark, path)
    if layout_path is not None:
        layout = store.read_layout(spark, layout_path)
        found = metadata.extract(blocks.flatten(layout)).join(layout.select("doc_id", "source_path"), "doc_id")
    else:
        found = spark.createDataFrame([], "doc_id string, title string, authors array<string>, journal string, volume string, issue string, year string, doi string, issn string, references array<string>, source_path string")
    known = papers_of(found.withColumn("own_title", F.col("title"))).join(found.select(F.col("doc_id").alias("paper_id"), "title"), "paper_id")
    first = chunks.groupBy("paper_id").agg(F.first("source_markdown", True).alias("source"))
    stem = F.regexp_replace(F.nullif(F.regexp_extract("source", r"([^/]+?)(?:\.[^./]*)?$", 1), F.lit("")), "_filtered", "")
    none = F.array().cast("array<string>")
    papers = first.join(known, "paper_id", "left").select(
        F.lit(paper_id).alias("given"), "paper_id", F.coalesce("title", stem, "paper_id").alias("paper_title"), F.coalesce("authors", none).alias("authors"), "journal", "volume", "issue", "year", "doi", "issn",
        F.coalesce("references", none).alias("references"), F.col("source").alias("markdown_path"), "marker_json_path", F.lit(pdf_path).cast("string").alias("pdf_path"))
    if paper_id is not None:
        papers, chunks = papers.withColumn("paper_id", F.lit(paper_id)), chunks.withColumn("paper_id", F.lit(paper_id))
    return table_rows(chunks, papers.drop("given"), dimension)


def tsv(chunks: DataFrame) -> DataFrame:
    """Labelled chunks as lines (paper_id, section_pos, chunk_index, value) of eight columns joined by tabs."""
    none = F.lit("None")
    columns = ["title", F.col("chunk_index").cast("string"), F.col("word_count").cast("string"), F.coalesce("label", none), "source", F.coalesce("confidence", none),
               F.initcap(F.col("used_context").cast("string")), F.coalesce("reason", F.lit(""))]
    return chunks.select("paper_id", "section_pos", "chunk_index", F.concat_ws("\t", *columns).alias("value"))
