"""Section labels from titles, carried forward over the sections of a paper."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from scriptorium.functions import constants as C
from scriptorium.functions.text import label_title


def title_label(title):
    """The family of a title, or null."""
    key = label_title(title)
    out = F.lit(None).cast("string")
    for label, titles in C.TITLE_FAMILIES.items():
        out = F.when(key.isin(titles), label).otherwise(out)
    return out


def label_sections(sections: DataFrame) -> DataFrame:
    """Sections (paper_id, section_pos, title, heading_level, n_chunks) with label, source, confidence, needs_llm.

    By title; else a deeper section takes the last level-one label; else a level title such as B1 takes the last
    label; else unresolved. Sections without chunks carry nothing. The state is a fold over each paper's sections.
    """
    s = sections.withColumn("own", title_label(F.col("title"))).withColumn("cefr", label_title(F.col("title")).rlike(f"(?i){C.CEFR_TITLE}"))
    rows = F.array_sort(F.collect_list(F.struct("section_pos", F.col("heading_level").alias("level"), "own", "cefr", F.col("n_chunks").alias("n"), "title")))
    none = F.lit(None).cast("string")
    item = "struct<section_pos:int,title:string,heading_level:int,n_chunks:bigint,label:string,confidence:string>"
    start = F.struct(none.alias("top"), none.alias("prev"), F.array().cast(f"array<{item}>").alias("out"))

    def step(acc, x):
        inherited = F.when((x["level"] > 1) & acc["top"].isNotNull(), acc["top"]).when(x["cefr"], acc["prev"])
        label = F.coalesce(x["own"], inherited)
        says = (x["n"] > 0) & label.isNotNull()
        confidence = F.when(x["own"].isNotNull(), "high").when(label.isNotNull(), "medium")
        row = F.struct(x["section_pos"].cast("int").alias("section_pos"), x["title"].alias("title"), x["level"].cast("int").alias("heading_level"), x["n"].cast("long").alias("n_chunks"), label.alias("label"), confidence.alias("confidence"))
        return F.struct(F.when(says & (x["level"] == 1), label).otherwise(acc["top"]).alias("top"), F.when(says, label).otherwise(acc["prev"]).alias("prev"), F.concat(acc["out"], F.array(row)).alias("out"))

    folded = s.groupBy("paper_id").agg(rows.alias("rows")).select("paper_id", F.inline(F.aggregate("rows", start, step)["out"]))
    return folded.select("paper_id", "section_pos", "title", "heading_level", "n_chunks", "label", F.when(F.col("label").isNull(), "llm").otherwise("deterministic").alias("source"), "confidence", F.col("label").isNull().alias("needs_llm"))


def with_neighbours(sections: DataFrame) -> DataFrame:
    """Sections with the trimmed text before and after."""
    order = W.partitionBy("paper_id").orderBy("section_pos")
    return sections.withColumn("previous_text", F.trim(F.lag("content").over(order))).withColumn("next_text", F.trim(F.lead("content").over(order)))


def unresolved_papers(labelled: DataFrame) -> DataFrame:
    """Papers with an unresolved label, which full ingestion keeps back."""
    return labelled.groupBy("paper_id").agg(F.count_if("needs_llm").alias("n_unresolved")).where("n_unresolved > 0")


def normalize_decision(reply: DataFrame) -> DataFrame:
    """Model decisions (action, label, confidence, reason) as labels of the closed sets."""
    label = F.when(F.lower("action").isin(C.LABELS), F.lower("action")).otherwise(F.when(F.lower("label").isin(C.LABELS), F.lower("label")))
    return reply.withColumn("label", label).withColumn("confidence", F.when(F.lower("confidence").isin("high", "medium", "low"), F.lower("confidence")).otherwise("low")).withColumn("reason", F.coalesce(F.nullif(F.trim("reason"), F.lit("")), F.lit("no reason given")))
