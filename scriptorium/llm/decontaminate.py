"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Words are lower-cased runs of letters, digits and non-ASCII characters. Every ten consecutive words of a
benchmark item are a window; an item of fewer words is one window. The windows are sent to the executors as a
hash set when their texts fit BROADCAST_BYTES; a larger benchmark is dealt with in blocks of that size, each
block sent on its own, and the blocks' hits are united for each document. Whole texts are scanned; a window
that the set holds is compared word by word through its joined form, so hits are exact.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import keep_rows, map_rows, only, small_batches

WINDOW = 10
BROADCAST_BYTES = 32 << 20
MARK = "__hit_ranges"
#: Letters and digits in lower case and all bytes of non-ASCII characters stay, all else parts words.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


class Windows:
    """The windows of benchmark items: joined words to the items that hold them."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        self.items: dict[int, dict[bytes, set[str]]] = {}
        words: set[bytes] = set()
        for item, text in items:
            own = words_of(text)
            n = min(window, len(own))
            for i in range(len(own) - n + 1 if own else 0):
                self.items.setdefault(n, {}).setdefault(b" ".join(own[i : i + n]), set()).add(item)
            words.update(own)
        self.known = dict.fromkeys(words, 1)

    def hits(self, text: str | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Count of words, word ranges covered by occurrences (merged, end exclusive), items that occur."""
        own = words_of(text)
        known = np.fromiter(map(self.known.get, own, repeat(0)), np.int64, len(own))
        total = np.concatenate([[0], np.cumsum(known)])
        at: list[tuple[int, int]] = []
        items: set[str] = set()
        for n, windows in self.items.items():
            if n > len(own):
                continue
            for i in np.flatnonzero(total[n:] - total[:-n] == n).tolist():
                found = windows.get(b" ".join(own[i : i + n]))
                if found:
                    at.append((i, i + n))
                    items |= found
        return len(own), merged(at), items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def blocks(benchmark: DataFrame, item_col: str, text_col: str, most: int = BROADCAST_BYTES) -> Iterator[tuple]:
    """The benchmark's items in blocks of about `most` bytes, each small enough to broadcast."""
    items = only(benchmark, item=item_col, text=text_col).select(F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / most))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n))
    return (tuple(map(tuple, items.where(part == i).collect())) for i in range(n))


_made: dict = {}


def _of(sent, window: int) -> Windows:
    """A block's windows, made once in each process for as long as it works on that block."""
    items = sent.value
    if _made.get("items") is not items or _made["window"] != window:
        _made.update(items=items, window=window, windows=Windows(items, window))
    return _made["windows"]


def scan(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", window: int = WINDOW, most: int = BROADCAST_BYTES) -> DataFrame:
    """Rows (doc_id, n_words, spans array<struct<start, end>> of hit words, items array<string> sorted).

    One row for each input row. A null text has no words; null and repeated ids and repeated rows keep their
    rows (with more than one block, rows of equal id and text are told apart by a row number only for counting,
    and have equal hits). An empty benchmark hits nothing; an empty table gives no rows; benchmark items of
    equal id count once; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    given = only(docs, doc_id=id_col, text=text_col)
    parts = []
    for block in blocks(benchmark, item_col, item_text_col, most):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def work(rows, sent=sent):
            windows = _of(sent, window)
            for row in rows:
                n, at, items = windows.hits(row["text"])
                yield {"doc_id": row["doc_id"], "n_words": n, "spans": [{"start": s, "end": e} for s, e in at], "items": sorted(items), "text_key": hash_of(row["text"])}

        parts.append(map_rows(given, f"doc_id {kind}, n_words bigint, spans array<struct<start bigint, end bigint>>, items array<string>, text_key string", work))
    if len(parts) == 1:
        return parts[0].drop("text_key")
    union = parts[0].withColumn("first", F.lit(1))
    for p in parts[1:]:
        union = union.unionByName(p.withColumn("first", F.lit(0)))
    folded = union.groupBy("doc_id", "text_key").agg(
        F.first("n_words").alias("n_words"), F.sum("first").alias("copies"),
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    span = "array<struct<start:bigint,end:bigint>>"
    united = F.aggregate("spans", F.lit(None).cast(span), lambda done, s: F.when(done.isNull(), F.array(s)).when(
        s["start"] <= F.element_at(done, -1)["end"],
        F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))),
    ).otherwise(F.concat(done, F.array(s))))
    return folded.withColumn("spans", F.coalesce(united, F.array().cast(span))).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc_id", "n_words", "spans", "items")


def hash_of(text: str | None) -> str:
    import xxhash

    return "" if text is None else xxhash.xxh3_128_hexdigest(text.encode("utf-8", "replace"))


def without_spans(text: str, at: list[tuple[int, int]]) -> str:
    """The text without the hit words and what stands between them."""
    places = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for start, end in at:
        out.append(text[last : places[start][0]])
        last = places[end - 1][1]
    return "".join([*out, text[last:]])


def clean(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, most: int = BROADCAST_BYTES) -> DataFrame:
    """docs, all columns, without contaminated rows, or with remove="spans" without the hit spans.

    Hits are those in the text as it was given, of all blocks of the benchmark together: spans that overlap are
    removed as one, once, so the result doesn't depend on `most`. A null or empty text has no hits and stays as it
    is; null ids and repeated rows are rows like others; an empty benchmark removes nothing; an empty table gives
    no rows. Names of columns are free.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is documents or spans")
    if remove == "documents":
        for block in blocks(benchmark, item_col, item_text_col, most):
            sent = docs.sparkSession.sparkContext.broadcast(block)

            def kept(texts, sent=sent):
                windows = _of(sent, window)
                return texts, [not windows.hits(t)[1] for t in texts]

            docs = keep_rows(docs, text_col, kept)
        return docs
    # Ranges of words found so far travel beside the text until the last block has been looked for.
    found = next(f"{MARK}{i}" for i in count() if f"{MARK}{i}" not in docs.columns)
    columns = docs.columns
    small_batches(docs.sparkSession)
    marked = docs.withColumn(found, F.array().cast("array<bigint>"))
    for block in blocks(benchmark, item_col, item_text_col, most):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def more(batches, sent=sent):
            for batch in batches:
                windows = _of(sent, window)
                texts, ranges = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (text_col, found))
                own = [r + [x for at in windows.hits(t)[1] for x in at] for t, r in zip(texts, ranges, strict=True)]
                place = batch.schema.get_field_index(found)
                yield batch.set_column(place, batch.schema.field(place), pa.array(own, batch.schema.field(place).type))

        marked = marked.mapInArrow(more, marked.schema)

    def cut(batches):
        for batch in batches:
            place = batch.schema.get_field_index(text_col)
            texts, ranges = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (text_col, found))
            new = [without_spans(t, merged(list(zip(r[::2], r[1::2], strict=True)))) if r else t for t, r in zip(texts, ranges, strict=True)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))

    return marked.mapInArrow(cut, marked.schema).select(*[F.col(f"`{c}`") for c in columns])


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns, from the operator's spans and items."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return scan(docs, benchmark).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))
