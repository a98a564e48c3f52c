"""A stored inverted index, which full-text searches read instead of the texts.

A build is three Parquet tables in a folder of its own: postings (term, chunk_id, tf, dl) in BUCKETS partitions
by the term's CRC-32, sorted by term; terms (term, df) in the same partitions; statistics, written last, in one
row. A search reads the partitions of its terms only, and of those the row groups that may hold them. Postings are
dealt by ranges of bucket, term and chunk, so a frequent term's rows are shared out. A refresh writes a new
build; searches take the newest complete one, so a build that was cut off does no harm.
"""

from __future__ import annotations

import uuid
import zlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.operators.search import B, K1, best_first, query_terms, tokens

BUCKETS = 64


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, by spark.checkpoint.dir; a default where it is unset."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "/tmp/checkpoints")


class FullTextIndex:
    """BM25 over the newest build in `path`. Chunks need columns chunk_id and text; chunk ids are unique."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        if buckets <= 0:
            raise ValueError("the number of buckets must be positive")
        self.spark, self.path, self.buckets = spark, path, buckets

    def refresh(self, chunks: DataFrame) -> FullTextIndex:
        """Index all of chunks anew. A null text has no terms but counts as a chunk; an empty table gives an empty index."""
        build = f"{self.path}/{self._newest() + 1:09d}-{uuid.uuid4().hex}"
        bucket = F.pmod(F.crc32(F.col("term")), F.lit(self.buckets)).cast("int").alias("bucket")
        sized = chunks.select("chunk_id", tokens(F.col("text")).alias("t")).select("chunk_id", "t", F.array_size("t").alias("dl"))
        found = sized.select("chunk_id", "dl", F.explode("t").alias("term")).groupBy("term", "chunk_id").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))
        order = ("bucket", "term", "chunk_id")
        found.select("*", bucket).repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("bucket").parquet(f"{build}/postings")
        stored = self.spark.read.schema(self._postings(chunks)).parquet(f"{build}/postings")
        stored.groupBy("bucket", "term").agg(F.count("*").alias("df")).repartition("bucket").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{build}/terms")
        sized.agg(F.count("*").alias("n"), F.avg("dl").alias("avgdl")).withColumn("buckets", F.lit(self.buckets)).coalesce(1).write.parquet(f"{build}/statistics")
        return self

    @staticmethod
    def _postings(chunks: DataFrame) -> str:
        return f"term string, chunk_id {chunks.schema['chunk_id'].dataType.simpleString()}, tf bigint, dl int, bucket int"

    def _builds(self) -> list[str]:
        """Names of the complete builds, in order."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        store = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not store.exists(path):
            return []
        names = [f.getPath().getName() for f in store.listStatus(path)]
        child = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        return sorted(n for n in names if store.exists(child(f"{self.path}/{n}/statistics/_SUCCESS")))

    def _newest(self) -> int:
        return max((int(n.split("-")[0]) for n in self._builds()), default=0)

    def bm25(self, query: str) -> DataFrame:
        """Rows (chunk_id, fts_score) of the chunks that hold a query term."""
        builds = self._builds()
        if not builds:
            raise ValueError("there is no index yet")
        build = f"{self.path}/{builds[-1]}"
        stats = self.spark.read.parquet(f"{build}/statistics").first()
        terms = query_terms(query)
        places = sorted({zlib.crc32(t.encode()) % stats["buckets"] for t in terms})

        def wanted(table: str, schema: str | None = None) -> DataFrame:
            reader = self.spark.read.schema(schema) if schema else self.spark.read
            return reader.parquet(f"{build}/{table}").where(F.col("bucket").isin(places) & F.col("term").isin(terms))

        if not terms or not stats["n"] or stats["avgdl"] in (None, 0.0):
            return self.spark.createDataFrame([], "chunk_id string, fts_score double")
        df = F.col("df")
        idf = F.log(1 + (F.lit(stats["n"]) - df + 0.5) / (df + 0.5))
        weights = F.broadcast(wanted("terms").select("term", idf.alias("idf")))  # one row for each query term at most
        gain = F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.lit(stats["avgdl"])))
        # One sum for each term, added in the order of the query as the scan does, so that no score hangs on the order of rows.
        gains = wanted("postings").join(weights, "term").groupBy("chunk_id").agg(*[F.sum(F.when(F.col("term") == t, gain)).alias(f"g{i}") for i, t in enumerate(terms)])
        return gains.select("chunk_id", reduce(lambda a, i: a + F.coalesce(f"g{i}", F.lit(0.0)), range(len(terms)), F.lit(0.0)).alias("fts_score"))

    def topk(self, query: str, k: int) -> DataFrame:
        """Rows (chunk_id, fts_score) of the k best, ties by id."""
        return self.bm25(query).orderBy(best_first(), "chunk_id").limit(k)
