"""Bounded recent buffers fed by a stream of several topics (fan-in), held as keyed streaming state.

The state store holds, for every (topic, lane), the newest ``size`` items of
that lane; an item's lane is a hash of its order value, so a topic that gets
most of the stream is spread over ``lanes`` tasks. A topic's newest ``size``
items are among its lanes' newest, so a reader ranks at most
``lanes x size`` rows a topic. State does not grow with the stream, a restarted
query goes on from its last committed batch, and a batch that runs again
starts from the state before it. Other jobs read the buffers as of a
committed batch out of the query's checkpoint (the ``statestore`` source).

Defined cases: a null topic is a topic of its own; items without an order
value are the oldest; of items with the same topic and order value all stay
while there is room. Keys live in the memory of the executors unless the
session names the RocksDB provider, which many topics need.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semjoin.operators.serving import BUFFER_SIZE, recent_by_topic
from semjoin.sources.streams import read_topic_stream

# Ours: tasks that one topic's items are spread over. Fixed for a checkpoint's life.
LANES = 8
_OLDEST = -(1 << 63)
# An item is kept as JSON text, whole to the microsecond.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
_STATE = "at array<long>, item array<string>"


def _keep_newest(size: int):
    def keep(key: tuple, parts: Iterable[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame(dict(zip(("at", "item"), state.get))) if state.exists else pd.DataFrame({"at": [], "item": []})
        held = held.astype({"at": "int64", "item": object})
        for part in parts:
            held = pd.concat([held, part[["at", "item"]]], ignore_index=True).nlargest(size, "at")
        state.update((held["at"].tolist(), held["item"].tolist()))
        return iter(())
    return keep


def start(stream: DataFrame, checkpoint: str, size: int = BUFFER_SIZE, order_col: str = "arrival", trigger: dict | None = None,
          lanes: int = LANES):
    """Keep the newest ``size`` items of each ``topic`` of ``stream`` (largest ``order_col``, a long)."""
    if size < 1 or lanes < 1:
        raise ValueError(f"size and lanes must be >= 1, got {size!r} and {lanes!r}")
    at = F.coalesce(F.col(order_col).cast("long"), F.lit(_OLDEST))
    item = F.to_json(F.struct(*[F.col(f"`{c}`") for c in stream.columns]), _JSON)
    items = stream.select("topic", F.pmod(F.xxhash64(at, item), F.lit(lanes)).alias("lane"), at.alias("at"), item.alias("item"))
    kept = items.groupBy("topic", "lane").applyInPandasWithState(_keep_newest(size), "topic string", _STATE, "update", "NoTimeout")
    return (kept.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())


def read(spark: SparkSession, checkpoint: str, schema: str, size: int = BUFFER_SIZE, order_col: str = "arrival",
         batch_id: int | None = None) -> DataFrame:
    """The buffers after ``batch_id`` (the last committed batch if not given); no rows before the first batch."""
    state = spark.read.format("statestore")
    if batch_id is not None:
        state = state.option("batchId", batch_id)
    try:
        held = state.load(checkpoint)
    except PySparkException as e:
        if batch_id is not None or e.getCondition() not in ("STDS_COMMITTED_BATCH_UNAVAILABLE", "PATH_NOT_FOUND"):
            raise
        return spark.createDataFrame([], schema)
    items = held.select(F.explode("value.groupState.item").alias("item")).select(F.from_json("item", schema, _JSON).alias("i")).select("i.*")
    return recent_by_topic(items, size, order_col)


def start_on_topics(spark: SparkSession, servers: str, topics: str, checkpoint: str, size: int = BUFFER_SIZE,
                    trigger: dict | None = None):
    """Tail Kafka topics (from their ends) into the buffers; items are JSON objects with a ``time``, ordered by broker time."""
    rows = read_topic_stream(spark, servers, topics, starting="latest", with_timestamp=True)
    items = rows.select("topic", F.unix_micros("timestamp").alias("arrival"), F.get_json_object("value", "$.time").alias("time"))
    return start(items, checkpoint, size, trigger=trigger or {"processingTime": "1 second"})
