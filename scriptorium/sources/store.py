"""Sources and sinks: layout JSON, Markdown, the chunk table with upsert, artifacts, stage manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.functions.text import chunk_id, preview
from scriptorium.operators.blocks import PAGES

CHUNK_COLUMNS = """chunk_id string, paper_id string, paper_title string, authors array<string>, journal string, volume string, issue string,
year int, doi string, issn string, references array<string>, section_title string, heading_level int, chunk_index int, text string, word_count int,
classification_label string, classification_source string, classification_confidence string, used_context boolean, reason string,
markdown_path string, marker_json_path string, pdf_path string, embedding array<float>"""


def read_layout(spark: SparkSession, path: str, pattern: str = "*.json", recursive: bool = False) -> DataFrame:
    """Layout documents (doc_id from the file's name, source_path, the columns of PAGES)."""
    raw = spark.read.schema(PAGES).option("multiLine", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).json(path)
    source = F.col("_metadata.file_path")
    return raw.select(F.regexp_extract(source, r"([^/]+?)(?:\.[^./]*)?$", 1).alias("doc_id"), source.alias("source_path"), "id", "children")


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.text(path, wholetext=True)
    source = F.col("_metadata.file_path")
    return raw.select(F.regexp_extract(source, r"([^/]+?)(?:\.[^./]*)?$", 1).alias("paper_id"), F.col("value").alias("markdown"))


def write_markdown(markdown: DataFrame, path: str) -> None:
    """One folder per document, so that documents keep their names."""
    markdown.select("doc_id", F.col("markdown").alias("value")).write.mode("overwrite").partitionBy("doc_id").text(path)


def denormalize(chunks: DataFrame, papers: DataFrame) -> DataFrame:
    """Chunks with their paper's columns and ids of the digest form."""
    return chunks.join(papers, "paper_id").withColumn("chunk_id", chunk_id(F.col("paper_id"), F.col("section_title"), F.col("chunk_index")))


class ChunkTable:
    """The chunk table: Parquet, partitioned by paper, replaced by partition."""

    def __init__(self, spark: SparkSession, path: str, dimension: int):
        if dimension <= 0:
            raise ValueError("the dimension must be positive")
        self.spark, self.path, self.dimension = spark, path, dimension

    def read(self) -> DataFrame:
        return self.spark.read.schema(CHUNK_COLUMNS).parquet(self.path)

    def _checked(self, rows: DataFrame) -> DataFrame:
        width = F.when(F.size("embedding") != self.dimension, F.raise_error(F.lit("a vector of another width"))).otherwise(F.col("embedding"))
        names = [c.split()[0] for c in CHUNK_COLUMNS.replace("\n", " ").split(", ")]
        return rows.withColumn("embedding", width.cast("array<float>")).select(*names)

    def append(self, rows: DataFrame) -> None:
        self._checked(rows).write.mode("append").partitionBy("paper_id").parquet(self.path)

    def upsert(self, rows: DataFrame) -> None:
        """Replaces the papers of these rows, and no others."""
        self._checked(rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("paper_id").parquet(self.path)

    def has_paper(self, paper_id: str) -> bool:
        return not self.read().where(F.col("paper_id") == paper_id).isEmpty()

    def delete_paper(self, paper_id: str) -> int:
        """One if there was such a paper; its partition's folder goes."""
        if not self.has_paper(paper_id):
            return 0
        jvm = self.spark.sparkContext._jvm
        name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(paper_id)
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/paper_id={name}")
        return int(folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True))

    def inspect(self, paper_id: str | None = None, limit: int = 5) -> DataFrame:
        rows = self.read()
        if paper_id is not None:
            rows = rows.where(F.col("paper_id") == paper_id)
        return rows.select("chunk_id", "paper_id", "section_title", "chunk_index", preview(F.col("text"), 160).alias("preview"), F.size("embedding").alias("width")).limit(limit)


def reusable(papers: DataFrame, manifest: DataFrame, stage: str, config_hash: str) -> DataFrame:
    """Papers that this stage has yet to do under this configuration."""
    done = manifest.where((F.col("stage") == stage) & (F.col("config_hash") == config_hash)).select("paper_id")
    return papers.join(done, "paper_id", "left_anti")


def classified_json(chunks: DataFrame) -> DataFrame:
    """One JSON document per paper: sections with their chunks and labels, nested, in order."""
    chunk = F.struct("chunk_index", "text", "word_count", F.struct(F.col("label"), F.col("source"), F.col("confidence"), F.col("needs_llm")).alias("classification"))
    parts = chunks.groupBy("paper_id", "section_pos", "title", "heading_level").agg(F.array_sort(F.collect_list(chunk)).alias("chunks"))
    whole = parts.groupBy("paper_id").agg(F.array_sort(F.collect_list(F.struct("section_pos", "title", "heading_level", "chunks"))).alias("headings"))
    return whole.select("paper_id", F.to_json(F.struct(F.size("headings").alias("total_heading_splits"), F.aggregate("headings", F.lit(0), lambda n, h: n + F.size(h["chunks"])).alias("total_chunks"), "headings")).alias("json"))


def read_classified(spark: SparkSession, path: str) -> DataFrame:
    """Rows of chunks from classified JSON; flags that are missing are false; no headings is an error."""
    schema = "source_markdown string, headings array<struct<title:string,heading_level:int,section_pos:int,chunks:array<struct<chunk_index:int,text:string,word_count:int,classification:struct<label:string,source:string,reason:string,confidence:string,used_context:boolean,needs_llm:boolean>>>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    name = F.regexp_replace(F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.[^./]*)?$", 1), "_classified_chunks$", "")
    raw = raw.select(name.alias("paper_id"), *raw.columns)
    headings = F.when(F.col("headings").isNull(), F.raise_error(F.lit("headings must be a list")).cast(raw.schema["headings"].dataType)).otherwise(F.col("headings"))
    rows = raw.select("paper_id", "source_markdown", F.posexplode(headings).alias("pos", "h")).select("paper_id", "source_markdown", "pos", "h.title", "h.heading_level", F.explode("h.chunks").alias("c"))
    return rows.select("paper_id", "source_markdown", F.col("pos").alias("section_pos"), "title", "heading_level", "c.chunk_index", "c.text", "c.word_count", "c.classification.label", "c.classification.source",
                       "c.classification.confidence", "c.classification.reason", F.coalesce("c.classification.used_context", F.lit(False)).alias("used_context"), F.coalesce("c.classification.needs_llm", F.lit(False)).alias("needs_llm"))


def query_artifact(ranked: DataFrame, header: dict[str, str]) -> DataFrame:
    """One row: the ranked chunks as Markdown. ranked is a bounded list with position."""
    missing = F.lit("[missing]")
    lines = F.concat_ws("\n", F.concat(F.lit("### Rank "), F.col("position").cast("string")), F.concat(F.lit("chunk_id: "), "chunk_id"), F.concat(F.lit("paper_id: "), "paper_id"),
                        F.concat(F.lit("authors: "), F.coalesce(F.nullif(F.array_join("authors", ", "), F.lit("")), missing)), F.concat(F.lit("year: "), F.coalesce(F.col("year").cast("string"), missing)),
                        F.format_string("rrf_score: %.6f", "rrf_score"), F.concat(F.lit("retrieval_keys: "), F.array_join("retrieval_keys", ", ")), F.lit("```text"), "text", F.lit("```"))
    head = "\n".join(["# Query Output", "", *[f"{k}: {v or '[none]'}" for k, v in header.items()], "", "## Ranked Chunks", "", ""])
    rows = F.array_sort(F.collect_list(F.struct("position", lines.alias("l"))))
    return ranked.agg(rows.alias("r")).select(F.concat(F.lit(head), F.array_join(F.transform("r", lambda x: x["l"]), "\n\n"), F.lit("\n")).alias("value"))
