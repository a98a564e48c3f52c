"""What the training-data operators share: table access, Arrow mapping and checkpoints."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BATCH = "512"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, read through Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small unless the session already chose a size."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under the operator's own names; the rest, clashing or not, is left out."""
    return df.select(*[df[f"`{source}`"].alias(name) for name, source in columns.items()])


def map_rows(df: DataFrame, schema: str | T.StructType, work: Callable[[list[dict]], Iterable[dict]]) -> DataFrame:
    """Arrow batches in, Arrow batches out, where `work` turns a list of rows into rows of `schema`."""
    small_batches(df.sparkSession)
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out)
        for batch in batches:
            yield pa.RecordBatch.from_pylist(list(work(batch.to_pylist())), schema=arrow)

    return df.mapInArrow(run, out)


def keep_rows(df: DataFrame, column: str, work: Callable[[list], tuple[list, list[bool]]], renew: bool = False) -> DataFrame:
    """All columns of df, of the rows that `work` keeps; with renew the column gets `work`'s values."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            values, kept = work(batch.column(at).to_pylist())
            if renew:
                batch = batch.set_column(at, batch.schema.field(at), pa.array(values, batch.schema.field(at).type))
            yield batch.filter(pa.array(kept, pa.bool_()))

    return df.mapInArrow(run, df.schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share; a default where it is unset."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "/tmp/checkpoints")


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable copy in the shared folder."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared store that nothing reads any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of frames that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def least_label(nodes_edges: DataFrame) -> DataFrame:
    """Components of an edge table (a, b): rows (node, component), component the least node reachable.

    Alternates large-star and small-star steps until the edges no longer change. Each step groups on the
    larger or the smaller end, with partial minima before the shuffle, and joins the minima back, where
    Spark can split the partitions of hot nodes. Self-loops are ignored; an empty table gives no rows.
    """
    edges = checkpoint(
        nodes_edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")),
        )).alias("e")).select("e.*").where("u <> v").distinct()
        edges = checkpoint(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                edges.select(F.col("v"), F.col("v")).distinct()
            )
        before = now
