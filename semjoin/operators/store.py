"""Storing processed news: two tables written from one keyed batch, plus integrity checks.

``news`` and ``news_embeddings`` rows are cut from the same persisted batch, so
they share ids by construction (no news row without its vector). Each batch
writes its own ``batch_id=<n>`` folder of either table and overwrites it
whole: replaying a micro-batch after a failure leaves exactly the replay's
rows there, also when the replay has none.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from semjoin.operators.ids import with_dense_index
from semjoin.operators.news import DB_SAVED, date_value, time_value
from semjoin.operators.partitioning import has_python_step, materialize_python

ID_STRIDE = 1 << 32   # ids are batch_id * ID_STRIDE + position in the batch + 1

NEWS_COLUMNS = ["id", "source", "published_date", "published_time", "headline", "created_at", "batch_id"]
NEWS_VECTOR_COLUMNS = ["id", "news_id", "embedding", "created_at", "batch_id"]


def number_batch(df: DataFrame, batch_id: int, col: str = "msg_key", value_col: str = "value") -> DataFrame:
    """Give every message of a batch a key in ``batch_id * ID_STRIDE + 1 .. (batch_id + 1) * ID_STRIDE``.

    The key depends on the messages alone, not on how they are split into
    tasks, so a replay gives the same keys on any cluster. Messages of a topic
    are keyed by (topic, partition, offset): an offset's distance from its
    partition's first plus the spans of the partitions before it, without a
    sort. Messages without offsets are numbered in the order of their text
    (equal texts are interchangeable). A batch that does not fit the stride
    fails instead of running into the next batch's keys.
    """
    if {"topic", "partition", "offset"} <= set(df.columns):
        own = ["topic", "partition"]
        spans = df.groupBy(*own).agg(F.min("offset").alias("_low"), (F.max("offset") - F.min("offset") + 1).alias("_span"))
        # one row per topic partition: a window over all of them is bounded by the broker's layout
        before = Window.orderBy(*own).rowsBetween(Window.unboundedPreceding, -1)
        starts = spans.select(*own, "_low", F.coalesce(F.sum("_span").over(before), F.lit(0)).alias("_base"))
        numbered = df.join(F.broadcast(starts), own).withColumn("_idx", F.col("_base") + F.col("offset") - F.col("_low"))
        numbered = numbered.drop("_low", "_base")
    else:
        # ranges of the hash alone: a sort by the texts would sample them whole, and the driver would hold the samples
        by_text = df.repartitionByRange(F.xxhash64(value_col)).sortWithinPartitions(F.xxhash64(value_col), value_col)
        numbered = with_dense_index(by_text, "_idx")
    fits = F.when(F.col("_idx") < ID_STRIDE, F.col("_idx")).otherwise(
        F.raise_error(F.lit(f"batch {batch_id} has more messages than ids ({ID_STRIDE})")).cast("long"))
    return numbered.withColumn(col, F.lit(batch_id * ID_STRIDE + 1) + fits).drop("_idx")


def with_news_id(processed: DataFrame, key: str = "msg_key") -> DataFrame:
    """``news_id`` = the message key for records the store accepts, NULL otherwise."""
    return processed.withColumn("news_id", F.when(F.col("db_status") == DB_SAVED, F.col(key)))


def news_tables(processed: DataFrame, batch_id: int, now: _dt.datetime) -> tuple[DataFrame, DataFrame]:
    """The ``news`` and ``news_embeddings`` rows of a processed batch (saved records only)."""
    saved = (processed.where(F.col("news_id").isNotNull())
             .withColumn("created_at", F.lit(now).cast("timestamp_ntz"))
             .withColumn("batch_id", F.lit(batch_id).cast("long")))
    news = saved.select(F.col("news_id").alias("id"), "source",
                        date_value(F.col("published_date")).alias("published_date"),
                        time_value(F.col("published_time")).alias("published_time"),
                        "headline", "created_at", "batch_id")
    vecs = saved.select(F.col("news_id").alias("id"), "news_id", "embedding", "created_at", "batch_id")
    return news, vecs


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the batch's folder of a table, replacing whatever an earlier attempt left there."""
    df.drop("batch_id").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def append_news(processed: DataFrame, root: str, batch_id: int, now: _dt.datetime) -> None:
    """Write the batch's saved rows to ``root/news`` and ``root/news_embeddings``.

    Both tables are cut from the rows, so rows that are not persisted yet are
    written to the shared folder first: they are embedded and matched once.
    """
    saved = processed.where(F.col("news_id").isNotNull())
    if has_python_step(saved):
        saved = materialize_python(saved.select("news_id", "source", "published_date", "published_time", "headline", "embedding"))
    news, vecs = news_tables(saved, batch_id, now)
    write_batch(news, f"{root}/news", batch_id)
    write_batch(vecs, f"{root}/news_embeddings", batch_id)


# --------------------------------------------------------------------------- referential integrity

def orphans(children: DataFrame, parents: DataFrame, fk: str, pk: str = "id") -> DataFrame:
    """Child rows whose parent is gone (``left_anti``)."""
    return children.join(parents.select(F.col(pk).alias(fk)), fk, "left_anti")


def cascade(children: DataFrame, parents: DataFrame, fk: str, pk: str = "id") -> DataFrame:
    """Child rows that survive a parent delete (``left_semi``): the cascade's outcome."""
    return children.join(parents.select(F.col(pk).alias(fk)), fk, "left_semi")
