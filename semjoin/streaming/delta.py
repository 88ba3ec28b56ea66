"""Delta push on a stream: every tick, at most N newest new items per topic, and the buffers' statistics.

``foreachBatch`` sees exactly the items that arrived since the previous tick
(the stream's own offsets), so "new since last tick" needs no counters; per
topic ``row_number() <= N`` keeps the newest N. A topic that did not grow has
no rows in the batch and sends nothing.

The statistics are a streaming aggregate of their own: a buffer holds
``min(items so far, size)`` items and the newest one, so two counts and two
latest times are all its state, partially aggregated in every map task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from semjoin.operators.serving import BUFFER_SIZE, DELTA_MAX_ITEMS, buffer_stats
from semjoin.operators.topn import top_n_per_key

BUFFER_SCHEMA = "topic string, arrival long, time string"


def tick(batch: DataFrame, max_items: int = DELTA_MAX_ITEMS, order_col: str = "arrival") -> DataFrame:
    return top_n_per_key(batch, "topic", order_col, max_items)


def _trigger(interval: str, available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": interval}


def start_items(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, interval: str = "1 second",
                max_items: int = DELTA_MAX_ITEMS, available_now: bool = False):
    """``sink(items, batch_id)`` receives each tick's newest new items."""
    w = stream.writeStream.foreachBatch(lambda batch, batch_id: sink(tick(batch, max_items), batch_id))
    return w.option("checkpointLocation", checkpoint).trigger(**_trigger(interval, available_now)).start()


def start_stats(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, interval: str = "1 second",
                size: int = BUFFER_SIZE, available_now: bool = False):
    """``sink(stats, batch_id)`` receives the one-row statistics after each tick."""
    w = buffer_stats(stream, size).writeStream.outputMode("complete").foreachBatch(sink)
    return w.option("checkpointLocation", checkpoint).trigger(**_trigger(interval, available_now)).start()
