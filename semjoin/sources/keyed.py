"""Keyed Parquet tables in hash buckets: an upsert rewrites only the buckets that its keys fall in.

A table is a Parquet folder partitioned by ``bucket``, the key's hash modulo a
number that stays fixed for the table's life. A change reads the buckets it
touches (a partition filter), puts their next contents under the shared
checkpoint folder, and writes them back by dynamic partition overwrite: files
of other buckets are neither read nor written, so a refresh costs in
proportion to what it touches. Choose the number so that a bucket holds about
128 MB; keys are unique in a table, so buckets are even.

Swapping folders is not atomic, so a writer of several buckets or tables names
its attempt before and after (``begin``, ``finish``), and a reader copies what
it needs and keeps the copy only if the same finished attempt stands before
and after (``copy_settled``).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ours: buckets of a table unless the caller says otherwise.
BUCKETS = 64
_MARK = "attempt string"


def bucket_of(key: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def create(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write a table afresh, whole."""
    df.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def append(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Add rows with new keys, a file for each bucket that they fall in; the files there stay as they are."""
    df.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket").write.mode("append").partitionBy("bucket").parquet(path)


def read(spark: SparkSession, path: str, schema: str, only: Iterable[int] | None = None) -> DataFrame:
    """The table's rows, of the buckets ``only`` if given (other folders are pruned); no rows if there is no table yet."""
    try:
        rows = spark.read.schema(f"{schema}, bucket int").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return (rows if only is None else rows.where(F.col("bucket").isin(list(only)))).drop("bucket")


def touched(changes: DataFrame, key: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets that the keys of ``changes`` fall in: at most ``buckets`` numbers."""
    return sorted(r.b for r in changes.select(bucket_of(key, buckets).alias("b")).distinct().collect())


def replace(df: DataFrame, path: str, key: str, only: list[int], buckets: int = BUCKETS) -> DataFrame:
    """Make ``df`` the whole contents of the buckets ``only``; returns it as written.

    ``df`` may read the table itself: it is checkpointed before any folder is
    replaced. A row outside ``only`` means that the table was made with
    another number of buckets, and fails the write.
    """
    from semjoin.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    if not only:
        return df
    bucket = bucket_of(key, buckets)
    wrong = F.raise_error(F.lit(f"{path} was not made with {buckets} buckets")).cast("int")
    rows = df.withColumn("bucket", F.when(bucket.isin(only), bucket).otherwise(wrong)).checkpoint(eager=True)
    (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(path))
    return rows.drop("bucket")


# --------------------------------------------------------------------------- attempts

def begin(spark: SparkSession, root: str, batch_id: int) -> str:
    """Tell readers that the tables under ``root`` are about to change."""
    attempt = f"{batch_id}-{uuid.uuid4().hex}"
    _mark(spark, f"{root}/begun", attempt)
    return attempt


def finish(spark: SparkSession, root: str, attempt: str) -> None:
    _mark(spark, f"{root}/finished", attempt)


def _mark(spark: SparkSession, path: str, attempt: str) -> None:
    spark.createDataFrame([(attempt,)], _MARK).coalesce(1).write.mode("overwrite").json(path)


def _marked(spark: SparkSession, path: str) -> str | None:
    try:
        row = spark.read.schema(_MARK).json(path).first()
    except PySparkException:                 # not there, or replaced while it was read
        return None
    return row and row.attempt


def settled(spark: SparkSession, root: str) -> str | None:
    """The attempt that was begun and finished last; None while one is under way, or broke off and was not run again."""
    done = _marked(spark, f"{root}/finished")
    return done if done is not None and done == _marked(spark, f"{root}/begun") else None


def never_written(spark: SparkSession, root: str) -> bool:
    """Whether no attempt has ever begun under ``root``."""
    try:
        spark.read.schema(_MARK).json(f"{root}/begun")
    except AnalysisException as e:
        return e.getCondition() == "PATH_NOT_FOUND"
    return False


def copy_settled(spark: SparkSession, root: str, query: Callable[[], DataFrame], wait_seconds: float = 60.0) -> tuple[str, DataFrame]:
    """(attempt, checkpointed result of ``query``), computed while no attempt was under way."""
    until, failure = time.monotonic() + wait_seconds, None
    while True:
        attempt = settled(spark, root)
        if attempt is not None:
            try:
                copy = query().checkpoint(eager=True)
            except Exception as e:           # a file went away under the query: only if an attempt began meanwhile
                if settled(spark, root) == attempt:
                    raise
                failure = e
            else:
                if settled(spark, root) == attempt:
                    return attempt, copy
        if time.monotonic() > until:
            raise TimeoutError(f"no finished state of {root} for {wait_seconds} s") from failure
        time.sleep(0.2)
