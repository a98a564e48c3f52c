"""Sections from Markdown headings, and overlapping word windows aligned to sentences."""

from __future__ import annotations

import bisect
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.functions.text import heading_title

HEADING = r"(?md)^(#{1,2})\s+(.+?)\s*$"
WORD, SENTENCE_END = re.compile(r"\S+"), re.compile(r"[.!?]['\")\]]*(?:\s+|$)")
TAIL_WORDS = 100


def sections(papers: DataFrame) -> DataFrame:
    """Rows (paper_id, section_pos, title, heading_level, raw_heading, content) of papers (paper_id, markdown).

    Text before the first heading belongs to no section; only levels one and two part sections.
    """
    text = F.col("markdown")
    heads, parts = F.regexp_extract_all(text, F.lit(HEADING), F.lit(0)), F.split(text, HEADING, -1)
    rows = papers.select("paper_id", F.posexplode(F.arrays_zip(heads.alias("raw"), F.slice(parts, 2, F.size(parts)).alias("content"))).alias("section_pos", "x"))
    rows = rows.where("x.raw IS NOT NULL")
    return rows.select(
        "paper_id", "section_pos", heading_title(F.regexp_extract("x.raw", HEADING, 2)).alias("title"), F.char_length(F.regexp_extract("x.raw", HEADING, 1)).alias("heading_level"),
        F.col("x.raw").alias("raw_heading"), F.regexp_replace("x.content", r"(?U)^\s+|\s+$", "").alias("content"))


def windows(content: str, min_words: int = 200, overlap: int = 50) -> list[tuple[int, int, int]]:
    """(start, end, words) of each chunk as character offsets.

    A chunk runs to the first sentence end at or after its min_words-th word. The next begins `overlap` words
    earlier, moved back to a sentence start where there is one after this chunk's start. A short rest is one
    chunk, begun `overlap` words earlier when it has fewer than 100 words.
    """
    words = [m.span() for m in WORD.finditer(content)]
    ends = [m.end() for m in SENTENCE_END.finditer(content)]
    starts = [s for s, _ in words]
    out, at, total = [], 0, len(words)

    def emit(first: int, stop_char: int) -> int:
        stop = bisect.bisect_left(starts, stop_char)
        out.append((starts[first], words[stop - 1][1], stop - first))
        return stop

    while at < total:
        left = total - at
        if out and left < min_words:
            emit(max(0, at - overlap) if left < TAIL_WORDS else at, len(content) + 1)
            break
        if left <= min_words:
            emit(at, len(content) + 1)
            break
        place = bisect.bisect_left(ends, words[at + min_words - 1][1])
        stop = emit(at, ends[place] if place < len(ends) else len(content) + 1)
        if stop >= total:
            break
        target = max(0, stop - overlap)
        nxt = target
        if target > at:
            place = bisect.bisect_left(ends, starts[target])
            if place:
                snapped = bisect.bisect_left(starts, ends[place - 1])
                nxt = snapped if snapped > at else target
        at = nxt if nxt > at else min(total, at + min_words)
    return out


def chunks(parts: DataFrame, min_words: int = 200, overlap: int = 50) -> DataFrame:
    """Rows (paper_id, section_pos, title, heading_level, chunk_index, start, end, text, word_count) of sections."""
    schema = "paper_id string, section_pos int, title string, heading_level int, chunk_index int, start int, end int, text string, word_count int"

    def run(batches):
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                for i, (s, e, n) in enumerate(windows(r["content"] or "", min_words, overlap)):
                    rows.append({**{k: r[k] for k in ("paper_id", "section_pos", "title", "heading_level")}, "chunk_index": i, "start": s, "end": e, "text": r["content"][s:e], "word_count": n})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("paper_id", pa.string()), ("section_pos", pa.int32()), ("title", pa.string()), ("heading_level", pa.int32()), ("chunk_index", pa.int32()),
                                                                    ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("word_count", pa.int32())]))

    return parts.select("paper_id", "section_pos", "title", "heading_level", "content").mapInArrow(run, schema)
