"""SimHash near-duplicates through Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into segments of 22, 21 and 21 bits. Two fingerprints that differ in at most
four bits differ, by the pigeonhole principle, in at most two bits over some pair of segments. Each segment is
decoded with the perfect binary Golay code (23, 12): every word lies within three bits of one codeword, whose
index of 12 bits stands for it. For each pair of segments a fingerprint gets the keys of all words within one
bit of it: a word halfway between two fingerprints that differ in two bits is within one bit of both, so they
share its key. That makes some thirty keys of 24 bits for each distinct fingerprint, copies counted once.

Fingerprints meet by key, sorted, in streams. A short run compares its pairs; a longer one is searched breadth
first, each fingerprint found once, so that it yields a spanning forest rather than all pairs. Components come
from those links by large-star and small-star steps.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import checkpoint, least_label, map_rows, only, small_batches

SHINGLE, SEED, LINK_BITS = 4, 42, 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the cyclic Golay code (fixed value).
GOLAY = 0b101011100011
SHORT_RUN = 16
#: Components that hold more than one in so many of the distinct fingerprints travel to every task.
MOST_HOT = 1000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of word shingles, as a signed 64-bit integer; zero without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    if n <= 1:
        hashes = [xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        hashes = [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)]
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.array(hashes[i : i + (1 << 14)], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def _remainder(x: int) -> int:
    for i in range(22, 10, -1):
        if x >> i & 1:
            x ^= GOLAY << (i - 11)
    return x


class Golay:
    """Decodes 23-bit words to the index of their codeword, by tables of syndromes."""

    def __init__(self):
        bits = np.array([_remainder(1 << i) for i in range(23)], np.uint16)
        self.low, self.high = np.zeros(1 << 12, np.uint16), np.zeros(1 << 11, np.uint16)
        for table, own in ((self.low, bits[:12]), (self.high, bits[12:])):
            for i, b in enumerate(own):
                table[1 << i : 2 << i] = table[: 1 << i] ^ b
        self.error = np.zeros(1 << 11, np.uint32)
        for weight in (1, 2, 3):
            for places in combinations(range(23), weight):
                self.error[np.bitwise_xor.reduce(bits[list(places)])] = sum(1 << p for p in places)

    def index(self, words: np.ndarray) -> np.ndarray:
        syndrome = self.low[words & 0xFFF] ^ self.high[words >> 12]
        return (words ^ self.error[syndrome]) >> 11


_golay: list[Golay] = []


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, key) of signed 64-bit fingerprints: each one's distinct keys."""
    if not _golay:
        _golay.append(Golay())
    decode = _golay[0].index
    raw = prints.view(np.uint64)
    own, near = [], []
    for at, width in SEGMENTS:
        word = ((raw >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.uint32)
        flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
        near.append(decode(word[:, None] ^ flips[None, :]).astype(np.int64))
        own.append(near[-1][:, :1])
    table = []
    for n, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        for x, y in ((near[a], own[b]), (own[a], near[b])):
            table.append(n << 24 | x << 12 | y)
    found = np.sort(np.concatenate(table, axis=1), axis=1)
    first = np.ones(found.shape, bool)
    first[:, 1:] = found[:, 1:] != found[:, :-1]
    rows, cols = np.nonzero(first)
    return rows, found[rows, cols]


def differing(a, b) -> np.ndarray:
    """Number of differing bits; unsigned, as numpy counts the bits of a signed number's absolute value."""
    return np.bitwise_count(np.asarray(a ^ b).view(np.uint64))


def links(prints: np.ndarray, most: int = LINK_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints, breadth first."""
    left, a, b = prints, [], []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            p = queue.pop()
            near = differing(left, p) <= most
            found = left[near]
            if len(found):
                a.append(np.full(len(found), p))
                b.append(found)
                queue.extend(found)
                left = left[~near]
    none = np.zeros(0, np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def run_links(key: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal keys."""
    starts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
    lengths = np.diff(starts)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    long = lengths > SHORT_RUN
    usual = np.repeat(~long, lengths)
    for step in range(1, min(SHORT_RUN, int(lengths.max(initial=0)))):
        at = np.flatnonzero((key[step:] == key[:-step]) & usual[step:])
        close = differing(prints[at], prints[at + step]) <= LINK_BITS
        a.append(prints[at[close]])
        b.append(prints[at[close] + step])
    for i in np.flatnonzero(long):
        x, y = links(np.unique(prints[starts[i] : starts[i + 1]]))
        a.append(x)
        b.append(y)
    return np.concatenate(a), np.concatenate(b)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, print bigint), one for each input row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def work(rows):
        for row in rows:
            yield {"doc_id": row["doc_id"], "print": fingerprint(row["text"])}

    return map_rows(only(docs, doc_id=id_col, text=text_col), f"doc_id {kind}, print bigint", work)


def print_links(distinct: DataFrame) -> DataFrame:
    """Rows (a, b): enough links between the distinct values of column print to connect every component."""
    small_batches(distinct.sparkSession)

    def keyed(batches):
        for batch in batches:
            if batch.num_rows:
                prints = batch.column(0).to_numpy(zero_copy_only=False)
                rows, found = keys(prints)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(prints[rows])], names=["key", "print"])

    def linked(batches):
        key, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
        waiting: list = []

        def out(key, prints):
            a, b = run_links(key, prints)
            pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)]), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        size = 0
        for batch in batches:
            waiting.append([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)])
            size += batch.num_rows
            if size < 1 << 18:
                continue
            key, prints = (np.concatenate([x, *[w[i] for w in waiting]]) for i, x in ((0, key), (1, prints)))
            waiting, size = [], 0
            cut = int(np.searchsorted(key, key[-1]))  # the last run may go on
            if cut:
                yield out(key[:cut], prints[:cut])
                key, prints = key[cut:], prints[cut:]
        if waiting or len(key):
            key, prints = (np.concatenate([x, *[w[i] for w in waiting]]) for i, x in ((0, key), (1, prints)))
            yield out(key, prints)

    met = distinct.select("print").mapInArrow(keyed, "key bigint, print bigint")
    return met.repartition("key").sortWithinPartitions("key").mapInArrow(linked, "a bigint, b bigint")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, print, component_id), one for each input row; component_id the least id reachable.

    A null text has no words and the fingerprint zero, which links like any other. Null ids never become a
    component's id; a component without any id has null. Repeated ids and rows keep their rows and link as
    copies. An empty table gives no rows; other columns are ignored.
    """
    own = checkpoint(fingerprints(docs, id_col, text_col))
    groups = checkpoint(own.groupBy("print").agg(F.min("doc_id").alias("least")))
    found = least_label(print_links(groups))
    rooted = groups.join(found, groups["print"] == found["node"], "left").select("print", "least", F.coalesce("component", "print").alias("root"))
    rooted = checkpoint(rooted)
    smallest = checkpoint(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n")))
    # A component of over 1 / MOST_HOT of the fingerprints would gather rows in one task: there are fewer than
    # MOST_HOT of them, so they travel; the others meet by their root.
    total = smallest.agg(F.sum("n")).first()[0] or 0
    hot = smallest["n"] > max(1, total // MOST_HOT)
    travelling = F.broadcast(smallest.where(hot).select("root", "component_id"))
    large = rooted.join(travelling, "root").select("print", "component_id")
    small = rooted.join(travelling, "root", "left_anti").join(smallest.where(~hot).select("root", "component_id"), "root").select("print", "component_id")
    return own.join(large.union(small), "print").select("doc_id", "print", "component_id")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with one document of each component: the one of least id.

    Rows that share an id count as one document, of which one row stays. Rows without an id stay.
    """
    kept = components(docs, id_col, text_col).where("doc_id = component_id").select(F.col("doc_id").alias("__kept_id")).distinct()
    rows = docs.join(kept, docs[f"`{id_col}`"] == kept["__kept_id"], "left_semi").dropDuplicates([id_col])
    return rows.unionByName(docs.where(docs[f"`{id_col}`"].isNull()))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, from the operator's fingerprints and components."""
    return components(docs).select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
