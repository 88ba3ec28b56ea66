"""Vectors kept by the digest of their text: a text is sent to the embedder once, however often and in whatever run it comes.

The store is a keyed Parquet table (``sources.keyed``) of digest and vector,
one per model, in hash buckets of the digest. ``embed_stored`` finds the
digests that the store lacks (an anti-join of digests alone), sends one text of
each to the embedder, appends the vectors, and joins them back to the rows.

Only vectors are stored: a text that got none (a failed or late request, no
token) is sent again by the next run. An append shows up whole or not at all,
so a run that broke off is simply run again. One run writes a store at a time;
should two overlap, a text may be embedded twice, and rows still get one vector.

Defined cases: a null or empty text gets NULL and is never sent; rows repeat as
they came; an empty input stores nothing; extra columns keep their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semjoin.operators.partitioning import materialize_python
from semjoin.session import shared_dir
from semjoin.sources import keyed

_SCHEMA = "digest binary, embedding array<float>"


def text_digest(text: Column) -> Column:
    """SHA-256 of the text's UTF-8 bytes; NULL for no text."""
    return F.unhex(F.sha2(F.when(F.length(text) > 0, text.cast("string")).cast("binary"), 256))


def stored_vectors(spark: SparkSession, path: str) -> DataFrame:
    """What the store holds: digest, embedding."""
    return keyed.read(spark, path, _SCHEMA)


def embed_stored(df: DataFrame, text_col: str, embedder: Callable[[Column], Column], path: str, out_col: str = "embedding",
                 buckets: int = keyed.BUCKETS) -> DataFrame:
    """``df`` plus ``out_col``, the vector of ``text_col``; texts new to the store at ``path`` are embedded and stored."""
    if out_col in df.columns:
        raise ValueError(f"{out_col!r} is a column already")
    spark = df.sparkSession
    df = materialize_python(df)                     # it is read for its digests, its new texts and its rows
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), text_digest(F.col(f"`{text_col}`")).alias("digest"))
    # digests only; partial aggregation leaves one row of a repeated text per map task
    wanted = _written(rows.where("digest IS NOT NULL").select("digest").distinct())
    missing = _written(wanted.join(stored_vectors(spark, path).select("digest"), "digest", "left_anti"))
    # one text a digest (all are equal), aggregated before the shuffle, so copies of a text don't meet in one task; where the
    # size of the files of ``missing`` lets Spark broadcast it, it filters the rows first and known texts aren't shuffled
    texts = rows.select("digest", F.col(f"row.`{text_col}`").cast("string").alias("text")).groupBy("digest").agg(F.max("text").alias("text"))
    # a fixed number of tasks: adaptive execution would put the few megabytes of a day's new texts into one
    tasks = int(str(spark.conf.get("spark.sql.shuffle.partitions")))
    once = texts.join(missing, "digest", "left_semi").repartition(tasks, "digest")
    vectors = once.select("digest", embedder(F.col("text")).cast("array<float>").alias("embedding")).where("embedding IS NOT NULL")
    keyed.append(vectors, path, "digest", buckets)
    found = stored_vectors(spark, path).join(wanted, "digest", "left_semi").groupBy("digest").agg(F.first("embedding").alias("vector"))
    # written, so that the join below is of two plain inputs, whose hot digests adaptive execution can split
    return rows.join(_written(found), "digest", "left").select("row.*", F.col("vector").alias(out_col))


def compact(spark: SparkSession, path: str, buckets: int = keyed.BUCKETS) -> None:
    """One file a bucket again, after many appends; not while a run uses the store."""
    held = stored_vectors(spark, path).groupBy("digest").agg(F.first("embedding").alias("embedding"))
    keyed.replace(held, path, "digest", list(range(buckets)), buckets)


def _written(df: DataFrame) -> DataFrame:
    path = shared_dir(df.sparkSession, "vectors")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
