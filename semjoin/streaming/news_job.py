"""The end-to-end news job on Structured Streaming.

Each micro-batch (``foreachBatch``) is numbered, parsed, embedded, matched
against the catalogue as it is *now* (re-read per batch), classified, stored
in two tables and its matched records published. The batch's messages are kept
on the executors' disks, its processed records once in the shared folder
(``processed``, overwritten by the next batch), and every sink reads the columns
it needs from there: memory does not follow the size of a batch. Beside them it keeps the messages that could not be parsed
(``bad_records``) and how many records got which statuses (``status_counts``).
All tables overwrite the batch's own folder, so a batch replayed after a
failure (the checkpoint commits only after ``foreachBatch`` returns) leaves
exactly one copy: at-least-once delivery, exactly-once tables.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable, Hashable

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from semjoin.operators import match as M
from semjoin.operators import news as N
from semjoin.operators import publish as P
from semjoin.operators import store as S
from semjoin.sources.streams import publish_to_topic, read_topic_stream


SOURCE_COLUMNS = ("topic", "partition", "offset")
# What the stores and the publisher need of a processed record; its normalised fields are read out of ``record`` again.
PROCESSED_COLUMNS = ("record", "embedding", *P.RESULT_KEYS)


def _messages(batch: DataFrame, batch_id: int, value_col: str) -> DataFrame:
    """The batch's messages with their keys and, from a topic, their positions."""
    return S.number_batch(batch.select(value_col, *[c for c in SOURCE_COLUMNS if c in batch.columns]), batch_id, value_col=value_col)


def process_batch(batch: DataFrame, batch_id: int, *, embedder, catalogue: DataFrame, dim: int,
                  threshold: float, value_col: str = "value", **match_opts) -> DataFrame:
    """One batch through parse -> normalise -> embed -> match -> enrich -> status -> news_id."""
    return S.with_news_id(N.process(_messages(batch, batch_id, value_col), embedder, catalogue, dim=dim, threshold=threshold,
                                    value_col=value_col, **match_opts))


def _staged(processed: DataFrame, path: str) -> DataFrame:
    """The batch's records written once, in place of the last batch's, and read back by columns."""
    processed.select(*PROCESSED_COLUMNS).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return N.normalize_news(processed.sparkSession.read.parquet(path))


def publish_to_files(path: str):
    """The default sink: payloads as a Parquet table with a folder per batch."""
    return lambda df, batch_id: S.write_batch(df, path, batch_id)


def make_batch_writer(out_root: str, *, embedder, load_catalogue: Callable[[], DataFrame], dim: int,
                      threshold: float, now: Callable[[], _dt.datetime] | None = None,
                      catalogue_version: Callable[[], Hashable] | None = None,
                      publish: Callable[[DataFrame, int], None] | None = None, **match_opts):
    """The ``foreachBatch`` function.

    ``publish(df, batch_id)`` sends the payloads (column ``value``); the default
    writes them to ``out_root/published``, ``streams.publish_to_topic`` sends
    them to a Kafka topic.

    Without ``catalogue_version`` every batch reads, measures and broadcasts
    the catalogue afresh. With it (e.g. the latest committed version of a
    versioned catalogue table), the catalogue - persisted, measured and its
    matrix broadcast or its inverted lists trained - is kept while the version is unchanged and replaced
    when it changes, so a batch still sees the catalogue as it is when the
    batch starts but the driver no longer collects it every batch.
    """
    now = now or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    held: dict = {}
    publish = publish or publish_to_files(f"{out_root}/published")
    prepare = {k: match_opts[k] for k in ("max_broadcast_bytes", "strategy", "nlist", "seed") if k in match_opts}

    def current_catalogue():
        version = catalogue_version()
        if held.get("version", _NONE) != version:
            release_held()
            cat = load_catalogue().persist(StorageLevel.DISK_ONLY)
            held.update(version=version, catalogue=cat, prepared=M.prepare_catalogue(cat, dim, **prepare))
        return held["catalogue"], held["prepared"]

    def release_held():
        if "catalogue" in held:
            held["prepared"].release()
            held["catalogue"].unpersist()
        held.clear()

    def write(batch: DataFrame, batch_id: int) -> None:
        own = catalogue_version is None
        if not own:
            catalogue, prepared = current_catalogue()      # kept across batches: made outside the release block
        # not in memory: cached batches of whole texts fill the executors' heaps with large arrays
        batch = batch.persist(StorageLevel.DISK_ONLY)
        # broadcasts made for this batch alone are released with the batch
        with M.released_broadcasts():
            if own:
                # the catalogue as it is now, read once for this batch (size-checked inside the matcher)
                catalogue, prepared = load_catalogue().persist(StorageLevel.DISK_ONLY), None
            processed = process_batch(batch, batch_id, embedder=embedder, catalogue=catalogue, dim=dim,
                                      threshold=threshold, prepared=prepared, **match_opts)
            try:
                observed, seen = N.observed_statuses(processed)          # counted in the pass that stages the records
                processed = _staged(observed, f"{out_root}/processed")
                S.append_news(processed, out_root, batch_id, now())
                publish(P.payloads(processed), batch_id)
                counts = batch.sparkSession.createDataFrame(N.status_rows(seen), "embedding_status string, db_status string, n long")
                S.write_batch(counts, f"{out_root}/status_counts", batch_id)
                S.write_batch(N.bad_records(batch), f"{out_root}/bad_records", batch_id)
            finally:
                batch.unpersist()
                if own:
                    catalogue.unpersist()
    write.release = release_held
    return write


_NONE = object()


def start(stream: DataFrame, out_root: str, checkpoint: str, *, embedder, load_catalogue, dim: int,
          threshold: float = M.DEFAULT_THRESHOLD, trigger: dict | None = None, now=None,
          catalogue_version=None, publish=None, **match_opts):
    """Start the job; ``trigger`` defaults to ``availableNow`` (process what is there, then stop)."""
    writer = make_batch_writer(out_root, embedder=embedder, load_catalogue=load_catalogue, dim=dim,
                               threshold=threshold, now=now, catalogue_version=catalogue_version, publish=publish, **match_opts)
    w = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    w = w.trigger(**(trigger or {"availableNow": True}))
    q = w.start()
    q.release_catalogue = writer.release     # drop the held catalogue once the query has ended
    return q


def start_on_topics(spark, servers: str, in_topic: str, out_topic: str, out_root: str, checkpoint: str, **job):
    """The job between two Kafka topics: replay ``in_topic`` from its start, publish matches to ``out_topic``."""
    return start(read_topic_stream(spark, servers, in_topic, starting="earliest"), out_root, checkpoint,
                 publish=publish_to_topic(servers, out_topic), **job)
