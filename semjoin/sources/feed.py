"""Market feed snapshots landed as files.

A fetched feed snapshot is one JSON document (an array, or an object wrapping
it) that can only be parsed whole. Snapshots are landed as rows (``value`` =
the document, ``snap`` = fetch order) of Parquet files, many to a file, so that
listing and reading them costs by their size, not by their number. Documents
that something else left as one file each are read whole by
``read_feed_documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FEED_SCHEMA = "value string, snap long"
# Ours: bytes of a row group. A reader holds a whole group of documents this long at once (up to 4,096 of them).
ROW_GROUP_BYTES = 16 * 1024 * 1024


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEED_SCHEMA).parquet(path)


def stream_feed(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(FEED_SCHEMA).parquet(path)


def write_feed(docs: DataFrame, path: str) -> None:
    w = docs.select("value", docs["snap"].cast("long").alias("snap")).write.mode("append")
    w.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def read_feed_documents(spark: SparkSession, path: str) -> DataFrame:
    """One document per file: ``value`` (the JSON text) plus partition columns."""
    return spark.read.option("wholetext", "true").text(path)
