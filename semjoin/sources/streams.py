"""Message sources and sinks: Kafka topics, with file twins for offline runs.

The Kafka connector jar is not part of every deployment (nor of this test
environment), so the Kafka functions only build the reader/writer with the
reference's options; tests and the query catalogue use the file twins, which
produce the same ``value``/``topic`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic_stream(spark: SparkSession, servers: str, topics: str, starting: str = "earliest",
                      group_id: str | None = None, fail_on_data_loss: bool = True,
                      with_timestamp: bool = False) -> DataFrame:
    """Kafka topic(s) as a stream of ``topic, partition, offset, value`` (UTF-8 text).

    ``starting="earliest"`` replays the topic (the processing job);
    ``starting="latest"`` tails it (the serving consumers). Several topics may
    be given comma-separated and split later on ``topic``. Offsets that the
    broker has already deleted fail the query unless ``fail_on_data_loss`` is
    off. ``with_timestamp`` adds the broker's ``timestamp``.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topics).option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return r.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"),
                           *["timestamp"] * with_timestamp)


def publish_to_topic(servers: str, topic: str):
    """A sink for ``news_job``: ``publish(df, batch_id)`` sends a ``value`` column to a Kafka topic.

    Delivery is at least once: a replayed batch is sent again.
    """
    def publish(df: DataFrame, batch_id: int) -> None:
        (df.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("topic", topic).save())
    return publish


def read_message_files(spark: SparkSession, path: str, stream: bool = True,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """File twin of a topic: one message per line; the folder name is the topic when partitioned by ``topic``."""
    if stream:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path)
    return spark.read.text(path)


def write_message_files(df: DataFrame, path: str, partition_cols: list[str] | None = None,
                        per_file: int = 0) -> None:
    """Land messages (``value`` column) as text files, one message per line, at most ``per_file`` in a file (0: any)."""
    w = df.write.mode("append").option("maxRecordsPerFile", per_file)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.text(path)
