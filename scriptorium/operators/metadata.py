"""Bibliographic metadata of layout blocks, and checks of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions import constants as C
from scriptorium.functions import text as T
from scriptorium.functions.vectors import let


NONE = "array<string>"
#: Two capitalised words side by side, which every name has that is_person accepts.
NEIGHBOURS = r"[A-Z][A-Za-z'`\-]+[ ,;]+[A-Z]"


def distinct_by_key(texts):
    """The first of texts that are equal but for case and white space, in order."""
    def first(own):
        keyed = F.transform(own, lambda x: F.struct(T.normalize_title(x).alias("key"), x.alias("text")))
        return let(keyed, lambda k: let(k["key"], lambda keys: F.transform(F.filter(k, lambda x, i: F.array_position(keys, x["key"]) == i + 1), lambda x: x["text"])))

    return let(texts, first)


def in_turn(text):
    """Names among capitalised words that stand side by side: as soon as two or more of them make a person."""
    state = "struct<names:array<string>,held:array<string>,done:boolean>"
    start = F.struct(F.array().cast(NONE).alias("names"), F.array().cast(NONE).alias("held"), F.lit(False).alias("done"))

    def step(acc, token):
        held = F.concat(acc["held"], F.array(token))
        name = F.array_join(held, " ")
        none = F.array().cast(NONE)
        return (F.when(acc["done"] | T.is_affiliation(name, C.METADATA_AFFILIATIONS), F.struct(acc["names"].alias("names"), none.alias("held"), F.lit(True).alias("done")))
                .when(~token.rlike(C.NAME_TOKEN), F.struct(acc["names"].alias("names"), none.alias("held"), F.lit(False).alias("done")))
                .when((F.size(held) >= 2) & T.is_person(name), F.struct(F.concat(acc["names"], F.array(name)).alias("names"), none.alias("held"), F.lit(False).alias("done")))
                .otherwise(F.struct(acc["names"].alias("names"), F.when(F.size(held) >= 4, none).otherwise(held).alias("held"), F.lit(False).alias("done"))).cast(state))

    tokens = F.filter(F.transform(F.split(text, r"\s+"), lambda t: F.btrim(t, F.lit(" ,;"))), lambda t: t != "")
    return F.aggregate(tokens, start.cast(state), step)["names"]


def author_names(text):
    """Names in a front-matter text: marks go, and all from the first word of an affiliation on."""
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(T.clean_text(text), C.AUTHOR_MARKS, " "), r"\s*[,;:/]\s*", ", "), r"\s+", " ")

    def named(own):
        segment = F.btrim(F.regexp_replace(own, rf"(?i)(?:^|\s)\S*(?:{'|'.join(C.METADATA_AFFILIATIONS)}).*$", ""), F.lit(" ,;"))
        return let(segment, found)

    def found(x):
        line = (T.word_count(x) <= 8) & ~T.is_affiliation(x, C.METADATA_AFFILIATIONS) & ~F.lower(x).rlike("issn|doi|copyright") & x.rlike(C.AUTHOR_LINE)
        split = F.transform(F.split(x, r"\s+(?:and|&)\s+|,\s*(?=[A-Z][a-z])"), F.trim)
        listed = F.filter(F.transform(F.split(F.replace(F.replace(x, F.lit(" and "), F.lit(", ")), F.lit(" & "), F.lit(", ")), ","), lambda t: F.btrim(t, F.lit(" ,;"))), lambda t: t != "")
        inside = F.filter(F.regexp_extract_all(x, F.lit(C.NAMES_INSIDE), F.lit(0)), T.is_person)
        return (F.when(x == "", F.array().cast(NONE)).when(line, F.filter(split, T.is_person)).when(F.size(listed) > 1, F.filter(listed, T.is_person))
                .when(F.size(inside) > 0, inside).otherwise(in_turn(x)))

    front = F.lower(text).rlike("issn|doi|copyright")
    some = lambda x: F.when(x.rlike(NEIGHBOURS), named(x)).otherwise(F.array().cast(NONE))
    return F.when(front, F.array().cast(NONE)).otherwise(let(F.btrim(marked, F.lit(" ,")), some))


def year_of(identifier):
    """A year that a path or id begins a name with."""
    return F.coalesce(F.nullif(F.regexp_extract(identifier, r"\b((?:19|20)\d{2})[_-][A-Za-z]", 1), F.lit("")), F.nullif(F.regexp_extract(identifier, r"/((?:19|20)\d{2})_[^/]+", 1), F.lit("")))


def extract(blocks: DataFrame, excluded_titles: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, title, journal, volume, issue, year, doi, issn, authors, references) from blocks.

    The title is the longest heading of page 0 before the abstract, the first of equals. Journal fields come from
    the first two pages before the abstract, the year else from the source path, the ids of blocks of page 0 or
    the document's id, where blocks have columns source_path and document_id; references from the section of
    that name to the next heading: all items of lists, and texts that look like references.
    """
    excluded_titles = C.EXCLUDED_TITLES if excluded_titles is None else excluded_titles
    blank = F.lit(None).cast("string")
    for name in ("source_path", "document_id"):
        blocks = blocks if name in blocks.columns else blocks.withColumn(name, blank)
    head, on_front = F.coalesce(F.col("block_type") == "SectionHeader", F.lit(False)), F.col("page_pos") < 2
    df = blocks.withColumn("text", T.clean_text_block(T.html_to_text_metadata(F.coalesce("html", F.lit("")))))
    listed = F.filter(F.transform(F.coalesce("items", F.array().cast(NONE)), lambda h: T.clean_text_block(T.html_to_text_metadata(h))), lambda t: t != "")
    entries = F.when(head, F.array().cast(NONE)).when(F.col("block_type") == "ListGroup", listed).when(F.col("block_type").isin("Text", "ListItem") & (F.col("text") != "") & T.is_metadata_reference(F.col("text")), F.array("text")).otherwise(F.array().cast(NONE))
    df = df.withColumn("is_head", head).withColumn("texts", entries).withColumn("key", F.when(head, T.normalize_title(F.col("text"))))
    # One row for each document, and in it its blocks once, in order; later pages give headings and entries only.
    row = F.struct("page_pos", "block_pos", "is_head", F.when(F.col("is_head") | on_front, F.col("text")).alias("text"), "key", "texts", F.when(F.col("page_pos") == 0, year_of(F.col("block_id"))).alias("year"))
    whole = df.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_head") | on_front | (F.size("texts") > 0), row))).alias("b"),
        F.first(year_of(F.col("source_path")), True).alias("path_year"), F.first(year_of(F.col("document_id")), True).alias("own_year"))
    whole = whole.withColumn("heads", F.filter(F.transform("b", lambda x, i: F.struct(i.alias("i"), x["is_head"].alias("is_head"), x["page_pos"].alias("page_pos"), x["key"].alias("key"), x["text"].alias("text"))), lambda h: h["is_head"]))
    whole = whole.withColumn("abstract", F.coalesce(_first_at("heads", lambda h: h["key"] == "abstract"), F.size("b")))
    titled = F.filter("heads", lambda h: (h["i"] < F.col("abstract")) & (h["page_pos"] == 0) & (h["text"] != "") & ~h["key"].isin("", *excluded_titles))
    whole = whole.withColumn("title", F.array_max(F.transform(titled, lambda h: F.struct(T.word_count(h["text"]).alias("n"), (-h["i"]).alias("at"), T.clean_text(h["text"]).alias("title"))))["title"])
    whole = whole.withColumn("title_key", T.normalize_title(F.col("title")))
    whole = whole.withColumn("title_at", _first_at("heads", lambda h: h["key"] == F.col("title_key")))
    named = F.filter("heads", lambda h: (h["page_pos"] == 0) & (h["key"] != "") & ~F.coalesce(h["key"] == F.col("title_key"), F.lit(False)) & ~h["key"].isin(C.FRONT_MATTER_HEADINGS) & ~h["text"].rlike(C.NUMBERED_HEADING) & ~h["key"].rlike(r"\b(?:introduction|methods?|results?|discussion|conclusion|references)\b"))
    front = F.filter("b", lambda x, i: (x["page_pos"] < 2) & (i < F.col("abstract")))
    by_line = F.filter("b", lambda x, i: ~x["is_head"] & (x["page_pos"] == 0) & (i < F.col("abstract")) & (i > F.col("title_at")))
    # From a heading References to the next heading.
    until = F.concat(F.slice(F.transform("heads", lambda h: h["i"]), F.lit(2), F.greatest(F.size("heads"), F.lit(0))), F.array(F.size("b")))
    parts = F.filter(F.zip_with("heads", until, lambda h, e: F.struct(h["key"].alias("key"), h["i"].alias("start"), e.alias("end"))), lambda r: r["key"] == "references")
    given = F.filter(F.transform("b", lambda x, i: F.struct(i.alias("i"), x["texts"].alias("texts"))), lambda x: F.size(x["texts"]) > 0)
    whole = whole.withColumn("parts", parts).withColumn("given", F.when(F.size("parts") > 0, given))
    listed = F.transform(F.filter("given", lambda x: F.exists("parts", lambda r: (x["i"] > r["start"]) & (x["i"] < r["end"]))), lambda x: x["texts"])
    block_year = F.try_element_at(F.filter(F.transform("b", lambda x: x["year"]), lambda y: y.isNotNull()), F.lit(1))
    whole = whole.select("doc_id", "title", T.clean_text(F.try_element_at(named, F.lit(1))["text"]).alias("journal"), F.array_join(F.transform(front, lambda x: x["text"]), "\n").alias("front"),
                         F.transform(by_line, lambda x: x["text"]).alias("author_text"), F.coalesce(F.flatten(listed), F.array().cast(NONE)).alias("refs"), F.coalesce("path_year", block_year, "own_year").alias("id_year"))

    def got(pattern: str):
        return F.nullif(F.regexp_extract("front", pattern, 1), F.lit(""))

    names = F.when(F.col("title").isNull(), F.array().cast(NONE)).otherwise(F.flatten(F.transform("author_text", author_names)))
    return whole.select("doc_id", "title", "journal", got(C.VOLUME).alias("volume"), got(C.ISSUE).alias("issue"), F.coalesce(got(C.YEAR), "id_year").alias("year"), got(C.DOI).alias("doi"), got(C.ISSN).alias("issn"),
                        distinct_by_key(names).alias("authors"), distinct_by_key(F.col("refs")).alias("references"))


def _first_at(heads: str, wanted):
    """The place of the first heading that is wanted, null if none is."""
    return F.array_min(F.transform(F.filter(heads, wanted), lambda h: h["i"]))


def missing_fields(metadata: DataFrame) -> DataFrame:
    """metadata with issues: names of fields that are absent or invalid."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    issues = F.filter(F.array(
        F.when(blank(F.col("title")), "title"), F.when(~F.exists(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.trim(a) != ""), "authors"),
        F.when(blank(F.col("journal")), "journal.name"), F.when(~F.coalesce(F.col("year"), F.lit("")).rlike(r"^\d+$"), "journal.year")), lambda x: x.isNotNull())
    return metadata.withColumn("issues", issues)


def repaired(metadata: DataFrame, overrides: DataFrame) -> DataFrame:
    """Fields of an override table (doc_id, title, journal, year, authors joined by ;) take the place of those found."""
    o = overrides.select("doc_id", F.col("title").alias("o_title"), F.col("journal").alias("o_journal"), F.col("year").alias("o_year"), F.split("authors", r"\s*;\s*").alias("o_authors"))
    joined = metadata.join(o, "doc_id", "left")
    return joined.select("doc_id", *[F.coalesce(f"o_{c}", c).alias(c) if c in ("title", "journal", "year", "authors") else F.col(c) for c in metadata.columns if c != "doc_id"])
