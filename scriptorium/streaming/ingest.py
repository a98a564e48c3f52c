"""Incremental ingestion: new layout files become chunks in the table, each batch an upsert."""

from __future__ import annotations

from pyspark.sql import SparkSession

from scriptorium.operators.blocks import PAGES


def ingest(spark: SparkSession, folder: str, checkpoint: str, to_rows, table):
    """Start a query that takes all new files of the folder once, then stops.

    to_rows turns layout documents into rows of the chunk table; a batch that is run again replaces its papers.
    """
    from pyspark.sql import functions as F

    stream = spark.readStream.schema(PAGES).option("multiLine", True).json(folder).withColumn("doc_id", F.regexp_extract("_metadata.file_path", r"([^/]+?)(?:\.[^./]*)?$", 1))
    return stream.writeStream.foreachBatch(lambda df, _: table.upsert(to_rows(df))).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
