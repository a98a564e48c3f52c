"""Layout blocks to filtered Markdown: flags, reasons of removal, assembly. Ordered state is windows by document.

blocks: (doc_id, page_pos, block_pos, block_id, block_type, html, items array<string>); order is page_pos, block_pos.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from scriptorium.functions import constants as C
from scriptorium.functions import text as T

#: The reason of blocks that hold nothing, and so aren't removed text.
EMPTY = "empty_text"
PAGES = "id string, children array<struct<id:string, children:array<struct<id:string, block_type:string, html:string, children:array<struct<id:string, block_type:string, html:string>>>>>>"


def flatten(documents: DataFrame) -> DataFrame:
    """Blocks of layout documents (doc_id, the columns of PAGES, and source_path if it is there)."""
    own = {"id": "document_id", "source_path": "source_path"}
    named = [F.col(c).alias(n) for c, n in own.items() if c in documents.columns]
    pages = documents.select("doc_id", *named, F.posexplode_outer("children").alias("page_pos", "page"))
    kept = ["doc_id", *[n for c, n in own.items() if c in documents.columns]]
    blocks = pages.select(*kept, "page_pos", F.posexplode("page.children").alias("block_pos", "b"))
    return blocks.select(*kept, "page_pos", "block_pos", F.col("b.id").alias("block_id"), "b.block_type", "b.html", F.transform("b.children", lambda c: c["html"]).alias("items"))


def flagged(blocks: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """All blocks with their cleaned text and the reason of removal, null for kept ones.

    metadata: (doc_id, title, authors). A heading that is the title goes, and a text that is an author's name; in
    the front matter also a text that names an affiliation. Texts and lists without any text have the reason EMPTY,
    which audits leave out.
    """
    order = W.partitionBy("doc_id").orderBy("page_pos", "block_pos")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    items = F.filter(F.transform("items", lambda h: T.clean_text_block(T.html_to_text(h))), lambda t: (t != "") & ~T.is_boilerplate(t))
    body = F.when(F.col("block_type") == "ListGroup", F.array_join(F.transform(items, lambda t: F.concat(F.lit("- "), t)), "\n")).otherwise(T.clean_text_block(T.html_to_text(F.coalesce("html", F.lit("")))))
    df = blocks.withColumn("text", body).withColumn("page_id", T.page_of(F.col("block_id"))).withColumn("head", F.when(F.col("block_type") == "SectionHeader", T.normalize_title(F.col("text"))))
    if metadata is not None:
        df = df.join(metadata.select("doc_id", F.col("title").alias("m_title"), F.col("authors").alias("m_authors")), "doc_id", "left")
    else:
        df = df.withColumn("m_title", F.lit(None).cast("string")).withColumn("m_authors", F.lit(None).cast("array<string>"))
    is_head = F.col("head").isNotNull()
    # Once for each block, before windows carry the rows on.
    df = df.withColumn("boilerplate", T.is_boilerplate(F.col("text"))).drop("html", "items")
    df = df.withColumn("cut", F.coalesce(F.max((F.col("head") == "references").cast("int")).over(so_far), F.lit(0)))
    df = df.withColumn("cut_before", F.coalesce(F.max((F.col("head") == "references").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    df = df.withColumn("excluded", F.coalesce(F.last(F.when(is_head, F.col("head").isin(C.EXCLUDED_SECTIONS)), True).over(so_far), F.lit(False)))
    df = df.withColumn("authors_open", F.coalesce(F.last(F.when(is_head, F.when(F.col("page_id") == 0, F.col("head") != "abstract").otherwise(False)), True).over(so_far), F.lit(True)))
    # The first heading of page 0 goes if the next is longer and nothing that says something stands between.
    heads = F.sum(is_head.cast("int")).over(so_far)
    meaningful = (~is_head & ~F.col("block_type").isin(C.SKIPPED_BLOCKS) & (F.trim("text") != "") & ~F.col("boilerplate")).cast("int")
    df = df.withColumn("n_head", F.when(F.col("page_pos") == 0, heads)).withColumn("said", meaningful)
    group = W.partitionBy("doc_id", "n_head")
    following = F.lead("text").over(W.partitionBy("doc_id", is_head).orderBy("page_pos", "block_pos"))
    next_page = F.lead("page_pos").over(W.partitionBy("doc_id", is_head).orderBy("page_pos", "block_pos"))
    df = df.withColumn("between", F.sum("said").over(group)).withColumn("next_head", F.when(is_head, following)).withColumn("next_page", F.when(is_head, next_page))
    suppressed = is_head & (F.col("page_id") == 0) & (F.col("n_head") == 1) & (F.col("next_page") == 0) & (F.col("between") == 0) & (T.word_count(F.col("text")) < T.word_count(F.col("next_head")))
    key = T.normalize_title(F.col("text"))
    names = F.transform(F.coalesce("m_authors", F.array().cast("array<string>")), T.normalize_title)
    author = F.array_contains(names, key) | (F.col("authors_open") & T.is_affiliation(F.col("text")))
    is_list, is_text = F.col("block_type") == "ListGroup", ~is_head & (F.col("block_type") != "ListGroup")
    titled = F.coalesce(key == T.normalize_title(F.col("m_title")), F.lit(False))
    reason = (
        F.when(F.col("cut_before") == 1, "after_references").when(F.col("cut") == 1, "references_cutoff")
        .when(F.col("excluded"), "excluded_section").when(F.col("block_type").isin(C.SKIPPED_BLOCKS), "skipped_block_type")
        .when(F.coalesce(suppressed, F.lit(False)), "title_page_heading").when(is_head & (F.col("boilerplate") | (F.trim("text") == "")), "boilerplate_heading")
        .when(is_head & titled, "metadata_title").when(~is_head & ~is_list & ~F.col("block_type").isin(C.KEPT_BLOCKS), "unsupported_block_type")
        .when(F.trim("text") == "", EMPTY).when(is_text & F.col("boilerplate"), "boilerplate_text")
        .when(is_text & F.coalesce(author, F.lit(False)), "metadata_author").when(is_text & T.is_reference_entry(F.col("text")), "reference_entry"))
    return df.select("doc_id", "page_pos", "block_pos", "block_id", "page_id", "block_type", "text", is_head.alias("is_heading"), reason.alias("reason"))


def audit(marked: DataFrame) -> DataFrame:
    """The removed blocks of flagged()."""
    return marked.where(F.col("reason").isNotNull() & (F.col("reason") != EMPTY))


def markdown(kept: DataFrame) -> DataFrame:
    """One row (doc_id, markdown) per document: headings with #, fragments of one paragraph joined by a blank.

    A text goes on from the text before unless that one ends with . ? ! : ; or it begins otherwise than with a
    lower-case letter, a bracket or a quote. Headings and lists stand alone.
    """
    order = W.partitionBy("doc_id").orderBy("page_pos", "block_pos")
    shown = F.when(F.col("is_heading"), F.concat(F.lit("# "), T.clean_text(F.col("text")))).otherwise(T.stripped(F.col("text")))
    kind = F.when(F.col("is_heading"), "heading").when(F.col("block_type") == "ListGroup", "list").otherwise("text")
    df = kept.select("doc_id", "page_pos", "block_pos", shown.alias("shown"), kind.alias("kind")).where("shown <> ''")
    df = df.withColumn("left", F.lag(F.struct("kind", "shown")).over(order))
    goes_on = (F.col("kind") == "text") & (F.col("left.kind") == "text") & ~F.col("left.shown").rlike(r"[.?!:;]$") & F.col("shown").rlike(r"""^(?:\p{Ll}|[(\["'])""")
    df = df.withColumn("piece", F.concat(F.when(F.col("left").isNull(), "").when(goes_on, " ").otherwise("\n\n"), "shown"))
    rows = F.array_sort(F.collect_list(F.struct("page_pos", "block_pos", "piece")))
    whole = F.array_join(F.transform("r", lambda x: x["piece"]), "")
    return df.groupBy("doc_id").agg(rows.alias("r")).select("doc_id", F.regexp_replace(whole, r"\n{3,}", "\n\n").alias("markdown"))
