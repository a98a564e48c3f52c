"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

A rotation of the principal axes is learnt on a bounded sample so that the signs of the rotated coordinates
make balanced binary codes that keep angles. Each code is cut into substrings; each substring indexes a table,
and vectors of one label that share a substring meet there and are compared by their original vectors, in
double precision. A pair that shares several substrings is compared in the first such table only. Exact copies
are one class from the start. Each bucket returns, for every class, the weight of its links, and a spanning
forest of the links; pairs themselves are never written. A bucket of more than BLOCK rows is split into blocks
that are compared two by two in different tasks.

Recall is a property of the codes: see the README for figures against brute force.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scriptorium.llm.common import checkpoint, least_label, small_batches

SIMILARITY = 0.98
#: The rotation is learnt on at most so many vectors, those of least hash.
SAMPLE = 20_000
TABLES, ITERATIONS, BLOCK, BROADCAST_KEYS = 6, 50, 2048, 100_000


def rotation(sample: np.ndarray, iterations: int = ITERATIONS, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Mean and matrix (dimension x bits): principal axes, turned until signs lose least."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    _, _, axes = np.linalg.svd(centred.T @ centred)
    bits = min(64, sample.shape[1])
    projected = centred @ axes[:bits].T
    turn, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    for _ in range(iterations):
        left, _, right = np.linalg.svd(np.where(projected @ turn >= 0, 1.0, -1.0).T @ projected)
        turn = (left @ right).T
    return mean, axes[:bits].T @ turn


def substrings(bits: int, tables: int) -> list[tuple[int, int]]:
    """Places (shift, width) of the substrings."""
    edges = np.linspace(0, bits, tables + 1).round().astype(int)
    return [(int(a), int(b - a)) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def codes(vectors: np.ndarray, mean: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    signs = (vectors - mean) @ matrix >= 0
    return (signs.astype(np.uint64) << np.arange(matrix.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def unit(rows: list | np.ndarray) -> np.ndarray:
    vectors = np.asarray(rows, np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def bucket_links(ids, weights, code, vectors, table: int, blocks, places, least: float):
    """Of one bucket: for each row the weight of its links first met in this table, and a forest of links."""
    n = len(ids)
    added = np.zeros(n, np.int64)
    parent = np.arange(n)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    a, b = [], []
    for at in range(0, n, 512):
        close = vectors[at : at + 512] @ vectors.T >= least
        differ = code[at : at + 512, None] ^ code[None, :]
        for shift, width in places[:table]:
            close &= (differ >> np.uint64(shift)) & np.uint64((1 << width) - 1) != 0
        if blocks is not None:
            close &= blocks[at : at + 512, None] != blocks[None, :]
        close[np.arange(len(close)), at + np.arange(len(close))] = False
        added[at : at + 512] += close @ weights
        for i in np.flatnonzero(close.any(axis=1)):
            for j in np.flatnonzero(close[i]):
                x, y = root(at + i), root(j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    a.append(ids[at + i])
                    b.append(ids[j])
    return added, a, b


def near_copies(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                similarity: float = SIMILARITY, sample: int = SAMPLE, tables: int = TABLES, block: int = BLOCK) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each input row.

    Vectors link when their labels are equal and not null and their cosine is `similarity` or more. Vectors that
    are null, empty, zero, hold a null or non-finite component, or have another length than most, and rows
    without id or label, link with nothing and are their own component. Rows that repeat an id are copies of one
    node. An empty table gives no rows; other columns are ignored.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    sound = F.coalesce((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0), F.lit(False))
    usable = rows.where(sound & F.col("id").isNotNull() & F.col("label").isNotNull())
    lengths = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    alone = F.lit(0).cast("long")
    if lengths is None:
        return rows.select(F.col("id").alias(id_col), alone.alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    usable = usable.where(F.size("v") == lengths["n"])
    chosen = usable.select("v").orderBy(F.xxhash64("id"), "id").limit(sample)
    mean, matrix = rotation(unit([r["v"] for r in chosen.toLocalIterator()]))
    places = substrings(matrix.shape[1], tables)

    key = [F.col("label"), F.xxhash64("v").alias("h1"), F.hash("v").alias("h2")]
    members = checkpoint(usable.select("id", *key))
    # Rows that repeat an id are one node: they count once and don't link to each other.
    once = usable.select("id", "v", *key).groupBy("label", "h1", "h2", "id").agg(F.first("v").alias("v"))
    classes = once.groupBy("label", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v"))
    classes = checkpoint(classes)

    def keyed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = unit(batch.column(3).to_pylist())
            code = codes(raw, mean, matrix)
            packed = [x.tobytes() for x in raw]
            label, rep, n = (batch.column(i) for i in range(3))
            for t, (shift, width) in enumerate(places):
                value = ((code >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([label, pa.array(np.full(len(raw), t, np.int32)), pa.array(value), rep, n, pa.array(code.view(np.int64)), pa.array(packed, pa.binary())],
                                                 names=["label", "t", "value", "rep", "n", "code", "v"])

    met = classes.select("label", "rep", "n", "v").mapInArrow(keyed, "label string, t int, value bigint, rep bigint, n bigint, code bigint, v binary")
    at = ["label", "t", "value"]
    hot = checkpoint(met.groupBy(*at).count().where(F.col("count") > block).select(*at, F.ceil(F.col("count") / block).cast("int").alias("parts")))
    hot = F.broadcast(hot) if hot.count() <= BROADCAST_KEYS else hot
    met = met.join(hot, at, "left").withColumn("own", F.pmod(F.xxhash64("rep"), F.coalesce("parts", F.lit(1))).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1), lambda other: F.struct(F.least("own", other).alias("x"), F.greatest("own", other).alias("y")))
    met = met.select(*at, "rep", "n", "code", "v", "own", F.explode(cells).alias("cell")).select(*at, "cell.x", "cell.y", "rep", "n", "code", "v", "own")

    def linked(batches):
        def close(run):
            if len(run) < 2:
                return None
            first = run[0]
            ids, weights, code, own = (np.array([r[k] for r in run]) for k in ("rep", "n", "code", "own"))
            matrix = np.frombuffer(b"".join([r["v"] for r in run]), np.float64).reshape(len(run), -1)
            added, a, b = bucket_links(ids, weights, code.view(np.uint64), matrix, first["t"], own if first["x"] != first["y"] else None, places, similarity)
            linked = np.flatnonzero(added)
            if not len(linked):
                return None
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids[linked], np.array(a, np.int64)])), pa.array(np.concatenate([added[linked], np.zeros(len(a), np.int64)])),
                                               pa.array([None] * len(linked) + list(b), pa.int64())], names=["a", "added", "b"])

        run: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if run and any(run[0][k] != row[k] for k in ("value", "t", "label", "x", "y")):
                    if (out := close(run)) is not None:
                        yield out
                    run = []
                run.append(row)
        if (out := close(run)) is not None:
            yield out

    where = [*at, "x", "y"]
    found = checkpoint(met.repartition(*where).sortWithinPartitions(*where).mapInArrow(linked, "a bigint, added bigint, b bigint"))
    counts = found.groupBy("a").agg(F.sum("added").alias("added")).where("added > 0")
    roots = least_label(found.where("b IS NOT NULL").select("a", "b"))
    info = classes.select("label", "h1", "h2", "rep", "n").join(counts, F.col("rep") == F.col("a"), "left").join(roots, F.col("rep") == F.col("node"), "left")
    info = info.select("label", "h1", "h2", (F.col("n") - 1 + F.coalesce("added", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    with_links = members.join(info, ["label", "h1", "h2"]).select("id", "n_links", "component_id")
    rest = rows.where(~F.coalesce(sound & F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") == lengths["n"]), F.lit(False)))
    every = with_links.unionByName(rest.select("id", alone.alias("n_links"), F.col("id").alias("component_id")))
    return every.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
