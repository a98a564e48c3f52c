"""Vector functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(vector: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in vector])


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def squared_l2(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Zero where a norm is zero; an error where widths differ."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    same = F.when(F.size(a) != F.size(b), F.raise_error(F.lit("vectors of different widths")).cast("double"))
    return F.coalesce(same, F.when(norm == 0, 0.0).otherwise(dot(a, b) / norm))


def hash_embedding(text: Column, dimension: int = 256) -> Column:
    """Signed counts of hashed tokens, of unit length; zero vectors stay zero.

    A token's bucket is the first eight bytes of its SHA-256 modulo the dimension, its sign the parity of the next.
    """
    if dimension <= 0:
        raise ValueError("the dimension must be positive")
    tokens = F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda t: t != "")
    digest = F.transform(tokens, lambda t: F.sha2(t, 256))
    signed = F.transform(digest, lambda d: F.struct(
        (F.conv(F.substring(d, 1, 16), 16, 10).cast("decimal(20,0)") % dimension).cast("int").alias("bucket"),
        F.when(F.conv(F.substring(d, 17, 2), 16, 10).cast("int") % 2 == 0, 1.0).otherwise(-1.0).alias("sign")))
    sums = F.aggregate(signed, F.map_from_arrays(F.array().cast("array<int>"), F.array().cast("array<double>")), lambda m, s: F.map_concat(
        F.map_filter(m, lambda k, _: k != s["bucket"]), F.create_map(s["bucket"], F.coalesce(F.try_element_at(m, s["bucket"]), F.lit(0.0)) + s["sign"])))
    places = F.sequence(F.lit(0), F.lit(dimension - 1))
    laid = let(sums, lambda m: F.transform(places, lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0.0))))
    return let(laid, lambda v: let(F.sqrt(dot(v, v)), lambda n: F.when(n == 0, v).otherwise(F.transform(v, lambda x: x / n))))


def let(value: Column, f) -> Column:
    """f of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def hash_embedding_rows(chunks, dimension: int = 256):
    """Rows (chunk_id, bucket, value) of the same vectors before scaling, relational, for texts of any length."""
    if dimension <= 0:
        raise ValueError("the dimension must be positive")
    tokens = chunks.select("chunk_id", F.explode(F.filter(F.split(F.lower("text"), r"(?U)\s+"), lambda t: t != "")).alias("t")).withColumn("d", F.sha2("t", 256))
    bucket = (F.conv(F.substring("d", 1, 16), 16, 10).cast("decimal(20,0)") % dimension).cast("int")
    sign = F.when(F.conv(F.substring("d", 17, 2), 16, 10).cast("int") % 2 == 0, 1).otherwise(-1)
    return tokens.groupBy("chunk_id", bucket.alias("bucket")).agg(F.sum(sign).alias("value"))
