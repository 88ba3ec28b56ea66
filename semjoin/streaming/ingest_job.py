"""Periodic catalogue refresh as a stream of landed feed snapshots.

Every micro-batch holds the snapshots that arrived since the last one. They
are applied in fetch order (``snap``, then position) as one keyed upsert to
markets (keyed on slug) and vectors (keyed on market id), both kept in hash
buckets: only the buckets that the feed's keys fall in are read and written
(``sources.keyed``). The run's counters are appended.

A batch's rows are parsed and embedded once, into ``staged`` under the
catalogue's root, and every later pass reads the columns it needs from there:
memory does not follow the size of a batch. The next batch overwrites it.

A replayed batch, also one that broke off between two folders, applies the
same rows again: rows already written keep their ids and creation times, the
rest are inserted. Ids are never given out twice; a broken batch can leave a
gap. The highest id is looked up (one column) when the job starts and counted
on from there, so one job at a time writes a catalogue.
"""

from __future__ import annotations

import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semjoin.operators import catalog as C
from semjoin.operators.store import write_batch
from semjoin.sources import keyed as KT

MARKETS_SCHEMA = ("id long, source string, slug string, question string, is_resolved boolean, "
                  "created_at timestamp_ntz, updated_at timestamp_ntz")
VECTORS_SCHEMA = "id long, market_id long, embedding array<float>, created_at timestamp_ntz"
STAGED_COLUMNS = ["slug", "question", "is_resolved", "source", "embedding", "status"]


def create(markets: DataFrame, vectors: DataFrame, root: str, buckets: int = KT.BUCKETS) -> None:
    """Lay down a catalogue from whole tables (an empty one needs no laying down)."""
    spark = markets.sparkSession
    attempt = KT.begin(spark, root, -1)
    KT.create(_as(markets, MARKETS_SCHEMA), f"{root}/markets", "slug", buckets)
    KT.create(_as(vectors, VECTORS_SCHEMA), f"{root}/market_embeddings", "market_id", buckets)
    KT.finish(spark, root, attempt)


def _as(df: DataFrame, schema: str) -> DataFrame:
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in (c.strip().split(" ") for c in schema.split(","))])


def read_markets(spark, root: str, only: list[int] | None = None) -> DataFrame:
    return KT.read(spark, f"{root}/markets", MARKETS_SCHEMA, only)


def read_vectors(spark, root: str, only: list[int] | None = None) -> DataFrame:
    return KT.read(spark, f"{root}/market_embeddings", VECTORS_SCHEMA, only)


def make_batch_writer(root: str, *, embedder, limit: int = C.DEFAULT_FEED_LIMIT,
                      source_tag: str = C.DEFAULT_SOURCE_TAG, order: list[str] | None = None,
                      now: Callable[[], _dt.datetime] | None = None, buckets: int = KT.BUCKETS):
    now = now or (lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    order = order or ["snap", "pos"]
    given: dict[str, int] = {}

    def write(docs: DataFrame, batch_id: int) -> None:
        spark = docs.sparkSession
        staged = _staged(C.ingest_status(C.normalize_feed(C.feed_rows(docs, limit), source_tag), embedder), root, order)
        ts = now()
        if "id" not in given:
            given["id"] = C.highest_id(read_markets(spark, root))
        ok = staged.where(F.col("status") == C.ST_OK)
        attempt = KT.begin(spark, root, batch_id)
        at = KT.touched(ok, "slug", buckets)
        markets = C.upsert_markets(read_markets(spark, root, at), staged, ts, order, last_id=given["id"])
        markets = KT.replace(_as(markets, MARKETS_SCHEMA), f"{root}/markets", "slug", at, buckets)
        given["id"] = max(given["id"], C.highest_id(markets))
        # vectors key on the ids just written; these buckets hold every slug of the run
        changed = markets.join(ok.select("slug"), "slug", "left_semi")
        at = KT.touched(changed, "id", buckets)
        vectors = C.upsert_market_embeddings(read_vectors(spark, root, at), changed, staged, ts, order)
        KT.replace(_as(vectors, VECTORS_SCHEMA), f"{root}/market_embeddings", "market_id", at, buckets)
        KT.finish(spark, root, attempt)
        write_batch(C.ingest_counters(staged), f"{root}/ingest_counters", batch_id)
    return write


def _staged(rows: DataFrame, root: str, order: list[str]) -> DataFrame:
    """What the upserts and counters need of a batch's rows, written once and read back by columns.

    Not cached: cached batches of whole questions fill the executors' heaps with large arrays.
    """
    rows.select(*order, *[c for c in STAGED_COLUMNS if c not in order]).write.mode("overwrite").parquet(f"{root}/staged")
    return rows.sparkSession.read.parquet(f"{root}/staged")


def start(stream: DataFrame, root: str, checkpoint: str, *, embedder, trigger: dict | None = None, **kw):
    """``stream``: feed documents (``value``) with their fetch order (``snap``)."""
    w = stream.writeStream.foreachBatch(make_batch_writer(root, embedder=embedder, **kw))
    w = w.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
    return w.start()


class StoredCatalogue:
    """What the news job matches against: open markets with vectors, as the ingest last finished them.

    ``version()`` names the refresh last finished; while one is under way it
    names the one seen before, so that the job keeps what it holds. ``load()``
    gives a checkpointed copy of one finished state, never of half a refresh:
    the state that ``version()`` named, or a newer one. Use as
    ``news_job.start(..., load_catalogue=c.load, catalogue_version=c.version)``.
    """

    def __init__(self, spark, root: str, wait_seconds: float = 60.0):
        self.spark, self.root, self.wait_seconds = spark, root, wait_seconds
        self._seen = None

    def version(self):
        self._seen = KT.settled(self.spark, self.root) or self._seen
        return self._seen

    def load(self) -> DataFrame:
        from semjoin.operators import match as M
        if KT.never_written(self.spark, self.root):
            return self._open(M)
        self._seen, copy = KT.copy_settled(self.spark, self.root, lambda: self._open(M), self.wait_seconds)
        return copy

    def _open(self, M) -> DataFrame:
        markets, vectors = read_markets(self.spark, self.root), read_vectors(self.spark, self.root)
        return M.match_catalogue(markets, vectors).select("id", "slug", "question", "embedding")
