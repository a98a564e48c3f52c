"""Language-model scoring with Katz backoff over word bigrams.

Tokens are lower-cased words and one end per text; they are known by 64-bit hashes. Counting: tasks add up the
tokens, then the bigrams, of about a million tokens in sorted arrays, cut them by hash range, and send one
block per range. Ranges are so many that each holds the counts of about RANGE_BYTES of text. The query keeps
every bigram seen; `seen` may be raised to count rarer ones as unseen.

A bigram meets its two words in turn. First it is dealt by its second word, whose count it takes up (a bigram of
one of the HEAD_WORDS most frequent words, whose counts travel, is dealt by both words, so that none of them
gathers rows); this table of distinct bigrams is stored. Then it is dealt by its context, where the masses of the
context are summed (those of the HOT_CONTEXTS most frequent contexts have been summed by then, and their bigrams
are dealt by both words); what comes out is the model.

The model: Good-Turing discounts for counts up to K; unigrams with their exact rest of mass for unknown words;
bigrams P(w|v) = d c(vw) / (c(v) + 1/2); and for other words alpha(v) P(w), where alpha(v) is the exact quotient
of the masses left. It is stored in tables of key and gain: a text's log probability is the unknown-word score
of its tokens plus the gains of the words and bigrams that the tables hold, which is the backoff recursion
unrolled for one step. All gains are log10, in steps of 2 ** -26.

Scoring: the MOST_HEAD most counted keys travel to every task, and so does a Bloom filter of BLOOM_BYTES over
the others; keys that may be among the others are sent in blocks to their hash range, looked up, and summed by
text. The filter's size is fixed; where it fills up, more keys are sent, and results stay the same.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import only, release, removed, shared_folder, small_batches

K, SEEN = 5, 2
CHUNK_TOKENS, HEAD_WORDS, HOT_CONTEXTS, MOST_HEAD, BLOOM_BYTES = 1_000_000, 1 << 16, 1 << 10, 600_000, 24 << 20
RANGE_BYTES, BLOCK_BYTES = 32 << 20, 8 << 20
STEP = 2.0**-26
U = np.uint64
NONE = np.zeros(0, U)


def _mark(seed: int) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(b"", seed)


START, END = _mark(98), _mark(99)


def hashes(text: str | None) -> np.ndarray:
    """Of the start, each word and the end."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    out = np.empty(len(words) + 2, U)
    out[0], out[-1] = START, END
    out[1:-1] = np.fromiter(map(xxh64_intdigest, words), U, len(words))
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_key(w: np.ndarray) -> np.ndarray:
    return mixed(w ^ U(0x9E3779B97F4A7C15))


def pair_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed((v * U(0xD6E8FEB86659FD93)) ^ mixed(w + U(0x632BE59BD9B4E019)))


def ranges(key: np.ndarray, parts: int) -> np.ndarray:
    """The hash range, of `parts` equal ones, that a key falls in."""
    return ((key >> U(32)) * U(parts)) >> U(32)


def found(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(keys), np.intp), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, a place of each in the input, sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.intp)
    return keys[first], order[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def _cut(part: np.ndarray, parts: int):
    """Slices of a sorted array of range numbers."""
    edges = np.searchsorted(part, np.arange(parts + 1, dtype=part.dtype))
    return [(p, slice(int(a), int(b))) for p, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]


def _blobs(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * len(types), types, strict=True)], names=names)


def chunks(batches, most: int):
    """Lists of the texts' hash arrays, of about `most` tokens."""
    waiting, size = [], 0
    for batch in batches:
        for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
            waiting.append(hashes(text))
            size += len(waiting[-1])
            if size >= most:
                yield waiting
                waiting, size = [], 0
    if waiting:
        yield waiting


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


BLOCK = "part int, kind int, a binary, b binary, c binary, d binary"
PAIRS = "part int, w binary, size binary, cw binary, v binary, known binary, n binary, of binary, hot binary"
TABLE = "part int, key binary, gain binary, n binary, word binary, buckets binary"


def packed(x: np.ndarray) -> bytes:
    """Counts in four bytes each, or in eight where one needs them."""
    return x.astype("<u4" if not len(x) or x.max() < 1 << 32 else "<u8").tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"<u{len(raw) // n}" if n else "<u4").astype(np.int64)


def pressed(x: np.ndarray) -> bytes:
    """Numbers byte by byte in planes, compressed: equal and zero bytes take next to nothing."""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes()
    return len(x).to_bytes(8, "little") + (pa.compress(planes, "zstd", asbytes=True) if len(x) else b"")


def unpressed(raw: bytes, kind) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = pa.decompress(raw[8:], n * size, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(kind).reshape(n)


def pressed_keys(keys: np.ndarray) -> bytes:
    """Keys in order, as their differences."""
    return pressed(np.diff(keys, prepend=U(0)))


def unpressed_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpressed(raw, U), dtype=U)


def joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def firsts(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and lengths of the runs of equal values."""
    at = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.intp)
    return at, np.diff(np.append(at, len(x)))


def count_words(texts: DataFrame, parts: int) -> DataFrame:
    """A block (part, a words in order, b counts) of each hash range, the end included."""

    def local(batches):
        for chunk in chunks(batches, CHUNK_TOKENS):
            w = np.concatenate([x[1:] for x in chunk])
            keys, at, n = added(word_key(w), np.ones(len(w), np.int64))
            w = w[at]
            yield _blobs(BLOCK, [(p, 0, w[s].tobytes(), packed(n[s]), b"", b"") for p, s in _cut(ranges(keys, parts), parts)])

    def whole(batches):
        for p, rows in runs(batches):
            w = [np.frombuffer(r["a"], U) for r in rows]
            n = np.concatenate([unpacked(r["b"], len(x)) for r, x in zip(rows, w, strict=True)])
            w, _, n = added(np.concatenate(w), n)
            yield _blobs(BLOCK, [(p, 0, w.tobytes(), packed(n), b"", b"")])

    met = texts.mapInArrow(local, BLOCK).repartitionById(parts, "part").sortWithinPartitions("part")
    return met.mapInArrow(whole, BLOCK)


def word_facts(words: DataFrame, most: int) -> tuple[int, int, int, dict[int, int], np.ndarray, np.ndarray]:
    """Tokens, distinct ones, texts, counts of counts up to K + 1, and the `most` most frequent words with counts."""
    end = np.uint64(END)

    def facts(batches):
        for batch in batches:
            for r in batch.to_pylist():
                w = np.frombuffer(r["a"], U)
                n = unpacked(r["b"], len(w))
                top = np.lexsort((w.view(np.int64), -n))[:most]
                kind = np.concatenate([np.zeros(len(top)), np.ones(K + 1), [2, 3, 4]]).astype(np.int32)
                which = np.concatenate([w[top].view(np.int64), np.arange(1, K + 2), [0, 0, 0]])
                value = np.concatenate([n[top], np.bincount(np.minimum(n, K + 2), minlength=K + 3)[1 : K + 2], [n.sum(), len(n), n[w == end].sum()]])
                yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(which), pa.array(value)], names=["kind", "h", "c"])

    found = words.select("a", "b").mapInArrow(facts, "kind int, h bigint, c bigint")
    sums = {(r["kind"], r["h"]): r["c"] for r in found.where("kind > 0").groupBy("kind", "h").agg(F.sum("c").alias("c")).collect()}
    top = found.where("kind = 0").orderBy(F.desc("c"), "h").limit(most).toPandas()
    of = {r: sums[1, r] for r in range(1, K + 2) if sums.get((1, r))}
    return *(int(sums.get((k, 0), 0)) for k in (2, 3, 4)), of, top["h"].to_numpy(np.int64).view(U), top["c"].to_numpy(np.int64)


def runs(batches, key: str = "part"):
    """Rows of each run of equal keys in a sorted stream."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and rows[0][key] != row[key]:
                yield rows[0][key], rows
                rows = []
            rows.append(row)
    if rows:
        yield rows[0][key], rows


def count_pairs(texts: DataFrame, words: DataFrame, parts: int, head, hot, seen: int) -> DataFrame:
    """A block of each range, PAIRS: second words with their counts, the contexts of each and the bigrams' counts.

    head: the most frequent words in order, with counts; hot: contexts whose numbers of bigrams by count, sums of
    larger counts and sums of the second words' counts by count are listed in the column hot. of counts all bigrams by count.
    """

    def local(batches):
        common = head.value[0]
        for chunk in chunks(batches, CHUNK_TOKENS):
            v, w = np.concatenate([x[:-1] for x in chunk]), np.concatenate([x[1:] for x in chunk])
            keys, at, n = added(pair_key(v, w), np.ones(len(v), np.int64))
            v, w = v[at], w[at]
            part = np.where(found(common, w)[1], ranges(keys, parts), ranges(word_key(w), parts))
            place, known = found(common, v)
            del keys, at
            rows = []
            for short in (True, False):
                chosen = np.flatnonzero(known if short else ~known)
                chosen = chosen[np.lexsort((w[chosen], part[chosen]))]
                own_w, own_n = w[chosen], n[chosen]
                own_v = place[chosen].astype(np.uint16) if short else v[chosen]
                for p, s in _cut(part[chosen], parts):
                    first, size = firsts(own_w[s])
                    rows.append((p, 1 if short else 2, own_w[s][first].tobytes(), packed(size), own_v[s].tobytes(), packed(own_n[s])))
            yield _blobs(BLOCK, rows)

    def whole(batches):
        common, counts = head.value[:2]
        warm = hot.value
        for p, rows in runs(batches):
            v, w, n = [], [], []
            known_w, known_c = NONE, np.zeros(0, np.int64)
            for r in rows:
                own = np.frombuffer(r["a"], U)
                if r["kind"] == 0:
                    known_w, known_c = own, unpacked(r["b"], len(own))
                    continue
                size = unpacked(r["b"], len(own))
                w.append(np.repeat(own, size))
                v.append(common[np.frombuffer(r["c"], np.uint16)] if r["kind"] == 1 else np.frombuffer(r["c"], U))
                n.append(unpacked(r["d"], len(v[-1])))
            rows.clear()
            v, w, n = joined(v, U), joined(w, U), joined(n, np.int64)
            _, at, n = added(pair_key(v, w), n)
            of = np.bincount(np.minimum(n, K + 2), minlength=K + 3).astype(np.int64)
            kept = n >= seen
            at, n = at[kept], n[kept]
            v, w = v[at], w[at]
            order = np.argsort(w, kind="stable")
            v, w, n = v[order], w[order], n[order]
            first, size = firsts(w)
            own = w[first]
            place, frequent = found(common, own)
            cw = np.zeros(len(own), np.int64)
            cw[frequent] = counts[place[frequent]]
            cw[~frequent] = known_c[found(known_w, own[~frequent])[0]] if len(known_w) else 0
            # Of hot contexts: bigrams by count, sum of larger counts; second words by count, sum of larger counts.
            at, is_hot = found(warm, v)
            at, many = at[is_hot], len(warm)
            sums = []
            for c in (n[is_hot], np.repeat(cw, size)[is_hot]):
                small = c <= K
                sums.append(np.bincount(at[small] * K + c[small] - 1, minlength=many * K).astype(np.float64).reshape(many, K))
                sums.append(np.bincount(at[~small], c[~small], many).reshape(many, 1))
            place, known = found(common, v)
            yield _blobs(PAIRS, [(p, own.tobytes(), packed(size), packed(cw), v[~known].tobytes() + place[known].astype(np.uint16).tobytes(), np.packbits(known).tobytes(), packed(n), of.tobytes(), np.hstack(sums).tobytes())])

    met = words.unionByName(texts.mapInArrow(local, BLOCK)).repartitionById(parts, "part").sortWithinPartitions("part", "kind")
    return met.mapInArrow(whole, PAIRS)


def discounts(n: dict[int, int]) -> dict[int, float]:
    """Katz's Good-Turing discounts of counts 1 to K; (r - 1/2) / r where the counts of counts give none."""
    out = {}
    cut = (K + 1) * n.get(K + 1, 0) / n[1] if n.get(1) else 1.0
    for r in range(1, K + 1):
        d = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - cut) / (1 - cut) if n.get(r) and cut < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def discounted(c: np.ndarray, d: dict[int, float]) -> np.ndarray:
    return c * np.array([0.0, *(d[r] for r in range(1, K + 1)), 1.0])[np.minimum(c, K + 1)]


def bucket(n: np.ndarray) -> np.ndarray:
    """Counts under 1024 as they are, larger ones by sixteenths of powers of two."""
    return np.where(n < 1024, n, 1024 + np.floor(np.log2(np.maximum(n, 1)) * 16).astype(np.int64))


@dataclass
class Model:
    """Stored tables and the numbers that scoring needs."""

    blocks: DataFrame
    parts: int
    tokens: int
    kinds: int
    unknown: float
    start: float
    head: object
    bloom: object
    hot: object


def train(texts: DataFrame, parts: int | None = None, seen: int = SEEN) -> Model:
    """Count and store a model of the column text of `texts`; bigrams seen less than `seen` times count as unseen.
    Null texts are empty; an empty table gives a model that knows nothing."""
    spark = texts.sparkSession
    sc = spark.sparkContext
    small_batches(spark)
    texts = texts.select("text")
    if parts is None:
        held = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // RANGE_BYTES))
    folder = f"{shared_folder(spark)}/katz-{uuid.uuid4().hex}"

    words = stored(count_words(texts, parts), folder, "words")
    tokens, kinds, n_texts, of, top, top_n = word_facts(words, HEAD_WORDS)
    release(spark)
    order = np.argsort(top)
    hot = np.unique(np.append(top[:HOT_CONTEXTS], U(START)))
    head, sent_hot = sc.broadcast((top[order], top_n[order])), sc.broadcast(hot)
    pairs = stored(count_pairs(texts, words, parts, head, sent_hot, seen), folder, "pairs")
    release(spark)

    d1 = discounts(of)
    mass = tokens - sum(n * r * (1 - d1[r]) for r, n in of.items() if r <= K)
    unknown = math.log10(1 - mass / (tokens + 1))
    met = np.zeros(K + 3, np.int64)
    for r in pairs.select("of").toLocalIterator():
        met += np.frombuffer(r["of"], np.int64)
    d2 = discounts({r: int(met[r]) for r in range(1, K + 2) if met[r]})

    # The masses of hot contexts.
    share = np.array([*(r * d2[r] for r in range(1, K + 1)), 1.0]), np.array([*(r * d1[r] for r in range(1, K + 1)), 1.0]) / (tokens + 1)

    def masses(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                sums = np.frombuffer(raw, np.float64).reshape(-1, 2 * (K + 1))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums[:, : K + 1] @ share[0]), pa.array(sums[:, K + 1 :] @ share[1])], names=["i", "d", "p"])

    hot_n = np.where(hot == U(START), n_texts, 0)
    place, frequent = found(top[order], hot)
    hot_n[frequent] = top_n[order][place[frequent]]
    hot_alpha = np.zeros(len(hot))
    for r in pairs.select("hot").mapInArrow(masses, "i bigint, d double, p double").groupBy("i").agg(F.sum("d").alias("d"), F.sum("p").alias("p")).collect():
        hot_alpha[r["i"]] = math.log10((1 - r["d"] / (hot_n[r["i"]] + 0.5)) / (1 - r["p"]))
    sent_alpha = sc.broadcast((hot, hot_n, hot_alpha))

    def dealt(batches):
        common = head.value[0]
        for batch in batches:
            for r in batch.to_pylist():
                own = np.frombuffer(r["w"], U)
                size = unpacked(r["size"], len(own))
                many = int(size.sum())
                known = np.unpackbits(np.frombuffer(r["known"], np.uint8), count=many).astype(bool)
                v, far = np.empty(many, U), 8 * int((~known).sum())
                v[~known], v[known] = np.frombuffer(r["v"][:far], U), common[np.frombuffer(r["v"][far:], np.uint16)]
                w, n, cw = np.repeat(own, size), unpacked(r["n"], many), np.repeat(unpacked(r["cw"], len(own)), size)
                part = np.where(found(sent_hot.value, v)[1], ranges(pair_key(v, w), parts), ranges(word_key(v), parts))
                place, frequent = found(common, w)
                rows = []
                # Second words that all tasks know go as their places, others with their counts after the bigrams'.
                for short in (True, False):
                    at = np.flatnonzero(frequent == short)
                    at = at[np.lexsort((v[at], part[at]))]
                    for p, s in _cut(part[at], parts):
                        i = at[s]
                        first, size = firsts(v[i])
                        words = place[i].astype(np.uint16) if short else w[i]
                        rows.append((p, 1 if short else 2, v[i][first].tobytes(), packed(size), words.tobytes(), packed(n[i] if short else np.concatenate([n[i], cw[i]]))))
                yield _blobs(BLOCK, rows)

    def tabled(batches):
        hot, hot_n, hot_alpha = sent_alpha.value
        common, counts = head.value
        for p, rows in runs(batches):
            w, c, v, second, n, cw = NONE, np.zeros(0, np.int64), [], [], [], []
            for r in rows:
                own = np.frombuffer(r["a"], U)
                if r["kind"] == 0:
                    w, c = own, unpacked(r["b"], len(own))
                    continue
                v.append(np.repeat(own, unpacked(r["b"], len(own))))
                many = len(v[-1])
                if r["kind"] == 1:
                    place = np.frombuffer(r["c"], np.uint16)
                    second.append(common[place])
                    n.append(unpacked(r["d"], many))
                    cw.append(counts[place])
                else:
                    both = unpacked(r["d"], 2 * many)
                    second.append(np.frombuffer(r["c"], U))
                    n.append(both[:many])
                    cw.append(both[many:])
            rows.clear()
            v, n, cw = joined(v, U), joined(n, np.int64), joined(cw, np.int64)
            key = pair_key(v, joined(second, U))
            del second
            d, q = discounted(n, d2), discounted(cw, d1) / (tokens + 1)
            at_hot, is_hot = found(hot, v)
            at = np.where(is_hot, 0, found(w, v)[0])
            mine = ~is_hot
            given, taken = np.bincount(at[mine], d[mine], len(w)), np.bincount(at[mine], q[mine], len(w))
            a = np.log10((1 - given / (c + 0.5)) / (1 - taken))
            place, frequent = found(hot, w)
            a[frequent] = hot_alpha[place[frequent]]
            if len(v):
                own_c = np.where(is_hot, hot_n[at_hot], c[at] if len(w) else 0)
                own_a = np.where(is_hot, hot_alpha[at_hot], a[at] if len(w) else 0.0)
                gain = np.log10(d / (own_c + 0.5)) - own_a - np.log10(q)
            else:
                gain = np.zeros(0)
            key = np.concatenate([word_key(w), key])
            gain = np.concatenate([np.log10(discounted(c, d1) / (tokens + 1)) + a - unknown, gain])
            n = np.concatenate([c, n])
            word = np.arange(len(key)) < len(c)
            by = np.argsort(key)
            seen_at, seen_n = np.unique(bucket(n), return_counts=True)
            yield _blobs(TABLE, [(p, pressed_keys(key[by]), pressed(np.rint(gain[by] / STEP).astype(np.int32)), pressed(n[by]), np.packbits(word[by]).tobytes(), np.stack([seen_at, seen_n]).astype(np.int64).tobytes())])

    met = words.unionByName(pairs.mapInArrow(dealt, BLOCK)).repartitionById(parts, "part").sortWithinPartitions("part", "kind")
    blocks = stored(met.mapInArrow(tabled, TABLE), folder, "gains")
    removed(spark, f"{folder}/pairs")
    removed(spark, f"{folder}/words")
    release(spark)

    # The most counted keys: the least bucket that leaves at most MOST_HEAD of them.
    def numbered(batches):
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                at, many = np.frombuffer(raw, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(many)], names=["bucket", "n"])

    counts = blocks.select("buckets").mapInArrow(numbered, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    least, total = 1 << 62, 0
    for r in sorted(counts, key=lambda r: -r["bucket"]):
        total += r["n"]
        if total > MOST_HEAD:
            break
        least = r["bucket"]

    bits = BLOOM_BYTES // parts * 8

    def heads(batches):
        for batch in batches:
            for r in batch.to_pylist():
                key, gain, n, word = opened(r)
                top = bucket(n) >= least
                field = np.zeros(bits, bool)
                for place in _places(key[~top], bits):
                    field[place] = True
                yield _blobs(BLOCK, [(r["part"], 0, key[top].tobytes(), gain[top].tobytes(), np.where(word, n, 0)[top].tobytes(), np.packbits(field, bitorder="little").tobytes())])

    rows = {r["part"]: r for r in blocks.mapInArrow(heads, BLOCK).toLocalIterator()}
    head = [joined([np.frombuffer(rows[p][x], t) for p in sorted(rows)], t) for x, t in (("a", U), ("b", np.float64), ("c", np.int64))]
    by = np.argsort(head[0])
    empty = bytes(-(-bits // 8))
    bloom = np.frombuffer(b"".join([bytes(rows[p]["d"]) if p in rows else empty for p in range(parts)]), np.uint8)
    return Model(blocks, parts, tokens, kinds, unknown, float(hot_alpha[hot == U(START)][0]), sc.broadcast(tuple(x[by] for x in head)), sc.broadcast(bloom), sent_hot)


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys in order, gains, counts and whether each is a word, of a row of TABLE."""
    key = unpressed_keys(row["key"])
    return key, unpressed(row["gain"], np.int32) * STEP, unpressed(row["n"], np.int64), np.unpackbits(np.frombuffer(row["word"], np.uint8), count=len(key)).astype(bool)


def _places(keys: np.ndarray, bits: int):
    for turn in (3, 17, 29):
        yield ((mixed(keys + U(turn)) >> U(32)) * U(bits)) >> U(32)


def gathered(batches):
    """The rows in batches of about BLOCK_BYTES, of fewer than 2 ** 16 rows each."""
    waiting, size = [], 0
    for batch in (b.slice(i, 1 << 14) for b in batches for i in range(0, b.num_rows, 1 << 14)):
        waiting.append(batch)
        size += batch.nbytes
        if size >= BLOCK_BYTES or sum(b.num_rows for b in waiting) > 1 << 15:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, size = [], 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


MEET = "part int, kind int, text_block bigint, key binary, gain binary, n binary, word binary"


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", held=None) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each input row.

    A null text is empty: its end is its only token. Null and repeated ids keep their rows; an empty table gives
    no rows; other columns are ignored. held is a condition on the id column, or nothing is held out.
    """
    given = only(docs, doc_id=id_col, text=text_col)
    given = given.withColumn("held", held(F.col("doc_id")) if held else F.lit(False))
    kind = docs.schema[id_col].dataType.simpleString()
    parts, head, bloom, bits = model.parts, model.head, model.bloom, BLOOM_BYTES // model.parts * 8
    hot = model.hot
    unknown, start, tokens, kinds = model.unknown, model.start, model.tokens, model.kinds
    least = math.log10(0.1) - math.log10(tokens + 0.1 * (kinds + 1))

    def sent(batches):
        keys, gains, counts = head.value
        field = bloom.value
        base = np.where(counts > 0, np.log10((counts + 0.1) / 0.1), 0.0)
        task, number = TaskContext.get().partitionId(), 0
        for batch in gathered(batches):
            texts = [hashes(t) for t in batch.column(1).to_pylist()]
            n = len(texts)
            sizes = np.array([len(t) - 1 for t in texts])
            doc = np.repeat(np.arange(n), sizes)
            w, v = np.concatenate([t[1:] for t in texts]), np.concatenate([t[:-1] for t in texts])
            sums = np.zeros((3, n))
            rows = []
            number += 1
            block = task << 32 | number
            far_keys, far_docs, far_parts = [], [], []
            from_word, from_pair = word_key(w), pair_key(v, w)
            dealt = ranges(from_word, parts), np.where(found(hot.value, v)[1], ranges(from_pair, parts), ranges(word_key(v), parts))
            for key, to in zip((from_word, from_pair), dealt, strict=True):
                at, hit = found(keys, key)
                near, where = doc[hit], at[hit]
                sums[0] += np.bincount(near, gains[where], n)
                sums[1] += np.bincount(near, base[where], n)
                sums[2] += np.bincount(near, counts[where] > 0, n)
                rest, own, part = key[~hit], doc[~hit], to[~hit]
                maybe = np.ones(len(rest), bool)
                for place in _places(rest, bits):
                    bit = part * U(-(-bits // 8) * 8) + place
                    maybe &= (field[bit >> U(3)] >> (bit & U(7)).astype(np.uint8)) & 1 == 1
                far_keys.append(rest[maybe])
                far_docs.append(own[maybe])
                far_parts.append(part[maybe])
            far, own, part = np.concatenate(far_keys), np.concatenate(far_docs).astype(np.uint16), np.concatenate(far_parts)
            order = np.lexsort((far, part))
            far, own = far[order], own[order]
            rows += [(p, 1, block, pressed_keys(far[s]), pressed(own[s]), b"", b"") for p, s in _cut(part[order], parts)]
            small = pa.BufferOutputStream()
            table = pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes), *[pa.array(s) for s in sums]], names=["doc_id", "held", "n", "gain", "base", "known"])
            with pa.ipc.new_stream(small, table.schema) as out:
                out.write_batch(table)
            rows.append((block % parts, 2, block, small.getvalue().to_pybytes(), b"", b"", b""))
            yield _blobs(MEET, rows)

    def looked_up(batches):
        part, table = None, None
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r["part"] != part:
                    part, table = r["part"], None
                if r["kind"] == 0:
                    key, gain, n, word = opened(r)
                    table = key, gain, np.where(word, n, 0)
                elif r["kind"] == 2:
                    out.append((r["text_block"], 2, r["key"], b"", b"", b""))
                elif table is not None:
                    key, doc = unpressed_keys(r["key"]), unpressed(r["gain"], np.uint16)
                    at, hit = found(table[0], key)
                    doc, at = doc[hit].astype(np.intp), at[hit]
                    c = table[2][at]
                    n = int(doc.max(initial=0)) + 1
                    gain = np.bincount(doc, table[1][at], n)
                    own = np.flatnonzero(np.bincount(doc, minlength=n))
                    word = c > 0
                    base, known = np.bincount(doc[word], np.log10((c[word] + 0.1) / 0.1), n), np.bincount(doc[word], minlength=n)
                    is_word = np.flatnonzero(known)
                    out.append((r["text_block"], 3, own.astype(np.uint16).tobytes() , gain[own].tobytes(), is_word.astype(np.uint16).tobytes(), base[is_word].tobytes() + known[is_word].astype(np.uint32).tobytes()))
            if out:
                yield _blobs("text_block bigint, kind int, a binary, b binary, c binary, d binary", out)

    def summed(batches):
        for _, rows in runs(batches, "text_block"):
            own = next(r for r in rows if r["kind"] == 2)
            table = pa.ipc.open_stream(own["a"]).read_all().combine_chunks()
            gain, base, known = (table.column(x).to_numpy().copy() for x in ("gain", "base", "known"))
            for r in rows:
                if r["kind"] == 3:
                    gain[np.frombuffer(r["a"], np.uint16)] += np.frombuffer(r["b"], np.float64)
                    at = np.frombuffer(r["c"], np.uint16)
                    base[at] += np.frombuffer(r["d"][: 8 * len(at)], np.float64)
                    known[at] += np.frombuffer(r["d"][8 * len(at) :], np.uint32)
            n = table.column("n").to_numpy()
            columns = [table.column("doc_id"), table.column("held"), pa.array(n), pa.array(known.astype(np.int64)), pa.array(np.full(len(n), tokens, np.int64)),
                       pa.array(n * least + base), pa.array(n * unknown + start + gain)]
            yield from pa.Table.from_arrays(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]).to_batches()

    ask = given.mapInArrow(sent, MEET)
    tell = model.blocks.select("part", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("text_block"), "key", "gain", "n", "word")
    met = tell.unionByName(ask).repartitionById(parts, "part").sortWithinPartitions("part", "kind")
    sums = met.mapInArrow(looked_up, "text_block bigint, kind int, a binary, b binary, c binary, d binary")
    return sums.repartition(parts, "text_block").sortWithinPartitions("text_block").mapInArrow(
        summed, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def digest(docs: DataFrame, seen: int = SEEN) -> DataFrame:
    """The contract's columns: a model of the rows that aren't held out scores all rows."""
    return score(docs, train(docs.where(~held_out(F.col("doc_id"))), seen=seen), held=held_out)
