"""Exact deduplication against a persistent digest index (DataFrame and SQL functions only).

The index is a table of SHA-256 digests, bucketed and sorted by digest. A batch of new rows is reduced to one row per
digest, deduplicated against the index by a sort-merge anti-join (the bucketed side is not shuffled) and what is new is
appended. Only digests and ids are shuffled, never texts; copies are counted before the shuffle, so a text that a third
of all rows share costs one row per task.

Defined cases: a null text counts as empty, and empty texts are copies of each other. Within a batch the row with the
largest id stays (a null id loses to any other); of repeated rows with the same id and text exactly one stays. A text
that an earlier batch added is dropped whatever its id, and its ``keep_id`` is the earlier row's. An empty table gives
an empty result. Extra columns are ignored, also when named like a column made here.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semjoin.llm.common import join_counted, stage, survivors
from semjoin.session import shared_dir


def digest(text: Column) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text; null counts as empty."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


class DigestIndex:
    """Digests seen so far: one row (text_sha256, keep_id, batch) per text, at ``path``, in ``buckets`` sorted buckets.

    ``buckets`` is fixed when the index is made (default: the session's shuffle partitions then, so that a shuffle by
    digest meets the buckets one to one) and kept beside it, so that a later session opens it with the same number.
    ``path`` must be in a folder that all executors share.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or shared_dir(spark, "llm", "digest_index")
        self.table = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()
        self.buckets = self._remembered(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (text_sha256 STRING, keep_id BIGINT, batch BIGINT) USING parquet "
                  f"CLUSTERED BY (text_sha256) SORTED BY (text_sha256) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def _remembered(self, n: int) -> int:
        """The number of buckets that the index was made with; ``n``, written down, for a new one."""
        note = f"{self.path}.buckets"
        try:
            return self.spark.read.schema("buckets int").json(note).first()[0]
        except AnalysisException:
            self.spark.range(1).select(F.lit(n).alias("buckets")).write.json(note)
            return n

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, batch: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Deduplicate ``docs`` against the index and itself, append what is new, return one row per row of ``docs``.

        Columns: doc_id, keep_id, group_size (rows of this batch with the text), kept, text_sha256. Running the same
        batch number again appends nothing and gives the same decisions.
        """
        rows = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), digest(F.col(text_col)).alias("text_sha256"),
                                 F.monotonically_increasing_id().alias("rid")), "digests")
        # the largest id first; of equal ids the first row
        groups = stage(rows.groupBy("text_sha256").agg(F.max(F.struct("doc_id", (-F.col("rid")).alias("neg"))).alias("win"),
                                                       F.count(F.lit(1)).alias("group_size")), "digest_groups")
        fresh = groups.join(self.rows().hint("merge"), "text_sha256", "left_anti")
        self._append(fresh.select("text_sha256", F.col("win.doc_id").alias("keep_id"), F.lit(batch).cast("long").alias("batch")))
        decided = groups.join(self.rows().hint("merge"), "text_sha256").select(
            "text_sha256", "keep_id", "group_size", F.when(F.col("batch") == batch, -F.col("win.neg")).alias("keep_rid"))
        out = join_counted(rows, decided, ["text_sha256"], "group_size", rows.count())
        return out.select("doc_id", "keep_id", "group_size", (F.col("rid").eqNullSafe(F.col("keep_rid"))).alias("kept"), "text_sha256")

    def _append(self, fresh: DataFrame) -> None:
        fresh.repartition(self.buckets, "text_sha256").write.mode("append").insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def keep_new(self, docs: DataFrame, batch: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows of ``docs`` that ``add`` keeps, whole."""
        won = self.add(docs, batch, id_col, text_col).filter("kept")
        return survivors(docs, won, doc_id=F.col(id_col).cast("long"), text_sha256=digest(F.col(text_col)))
