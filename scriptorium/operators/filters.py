"""Metadata filters of retrieval, as predicates that reach the scan."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class QueryFilters:
    paper_id: str | None = None
    paper_id_in: list[str] = field(default_factory=list)
    year: int | None = None
    year_min: int | None = None
    year_max: int | None = None
    paper_title_contains: str | None = None
    classification_label: str | None = None
    classification_label_in: list[str] = field(default_factory=list)
    section_title_contains: str | None = None
    author: str | None = None
    authors_any: list[str] = field(default_factory=list)


def pushed(f: QueryFilters) -> Column | None:
    """The part that the Parquet scan can use: equality, lists and ranges."""
    parts = [
        f.paper_id is not None and F.col("paper_id") == f.paper_id,
        f.paper_id_in and F.col("paper_id").isin(f.paper_id_in),
        f.year is not None and F.col("year") == f.year,
        f.year_min is not None and F.col("year") >= f.year_min,
        f.year_max is not None and F.col("year") <= f.year_max,
        f.classification_label is not None and F.coalesce(F.col("classification_label"), F.lit("")) == f.classification_label,
        f.classification_label_in and F.col("classification_label").isin(f.classification_label_in),
    ]
    parts = [p for p in parts if p is not False and p is not None and not isinstance(p, list)]
    return reduce(lambda a, b: a & b, parts) if parts else None


def residual(f: QueryFilters) -> Column | None:
    """Case-insensitive substrings of title, section and authors."""
    def within(column: Column, part: str) -> Column:
        return F.lower(column).contains(part.lower())

    parts = []
    if f.paper_title_contains:
        parts.append(within(F.col("paper_title"), f.paper_title_contains))
    if f.section_title_contains:
        parts.append(within(F.col("section_title"), f.section_title_contains))
    for wanted in ([f.author] if f.author else [], f.authors_any):
        if wanted:
            parts.append(F.exists("authors", _any_of(list(wanted))))
    return reduce(lambda a, b: a & b, parts) if parts else None


def _any_of(names: list[str]):
    return lambda a: reduce(lambda x, y: x | y, [F.lower(a).contains(n.lower()) for n in names])


def apply(chunks: DataFrame, f: QueryFilters) -> DataFrame:
    """Rows that satisfy all of it, before any top-k; nulls fail."""
    for condition in (pushed(f), residual(f)):
        if condition is not None:
            chunks = chunks.where(condition)
    return chunks


def expanded_limit(limit: int, f: QueryFilters) -> int:
    """The over-fetch of engines that filter after the search: five times, where a substring filter is set."""
    return limit * 5 if f.paper_title_contains or f.section_title_contains or f.author or f.authors_any else limit


def exclude(hits: DataFrame, chunk_ids: DataFrame | None = None, paper_ids: DataFrame | None = None) -> DataFrame:
    """Hits without the excluded chunks and papers; ranks keep their gaps."""
    if chunk_ids is not None:
        hits = hits.join(chunk_ids.select("chunk_id"), "chunk_id", "left_anti")
    if paper_ids is not None:
        hits = hits.join(paper_ids.select("paper_id"), "paper_id", "left_anti")
    return hits
