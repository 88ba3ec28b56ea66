"""Serving queries: listings, bounded recent buffers, statistics, audits and delta feeds.

The recent buffers are "latest N per topic by arrival" (``operators.topn``):
``row_number() <= N`` filters, which Spark turns into a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most N
rows per topic; when ``map tasks x N`` would still be too much for the one
task ranking a hot topic, a round per group of map partitions comes first.
A topic holding most of the log never reaches one task whole. Statistics are single-pass global aggregates of each
input; combined statistics put the one-row results together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semjoin.functions.text import iso_timestamp
from semjoin.operators.topn import top_n_per_key

# Fixed values of the serving layer.
BUFFER_SIZE = 1000
DEFAULT_LIST_LIMIT = 100
MAX_LIST_LIMIT = 1000
DELTA_MAX_ITEMS = 10
NEWS_TOPIC, PROCESSED_TOPIC = "news_stream", "processed_news"
MAX_BROADCAST_TOPICS = 100000      # ours: bound for shipping a per-topic table to every task


def _check_limit(limit: int, hi: int | None = None) -> None:
    if not isinstance(limit, int) or limit < 1 or (hi is not None and limit > hi):
        raise ValueError(f"limit must be an integer in 1..{hi or 'inf'}, got {limit!r}")


# --------------------------------------------------------------------------- markets

def markets_list(markets: DataFrame, limit: int = DEFAULT_LIST_LIMIT, is_resolved: bool | None = None) -> DataFrame:
    """Newest markets first (``created_at`` desc, then id), optionally filtered, timestamps as ISO text."""
    _check_limit(limit, MAX_LIST_LIMIT)
    m = markets.select("id", "source", "slug", "question", "is_resolved", "created_at", "updated_at")
    if is_resolved is not None:
        m = m.where(F.col("is_resolved") == F.lit(bool(is_resolved)))
    top = m.orderBy(F.desc("created_at"), F.asc("id")).limit(limit)
    return markets_iso(top)


def markets_iso(markets: DataFrame) -> DataFrame:
    return (markets.withColumn("created_at", iso_timestamp("created_at"))
                   .withColumn("updated_at", iso_timestamp("updated_at")))


# --------------------------------------------------------------------------- recent buffers

def recent_by_topic(arrivals: DataFrame, size: int = BUFFER_SIZE, order_col: str = "arrival") -> DataFrame:
    """The bounded buffer of each topic: its latest ``size`` items by arrival (bounded rows per task)."""
    _check_limit(size)
    return top_n_per_key(arrivals, "topic", order_col, size)


def recent(arrivals: DataFrame, topic: str, limit: int = DEFAULT_LIST_LIMIT, size: int = BUFFER_SIZE,
           order_col: str = "arrival") -> DataFrame:
    """Last ``limit`` items of one topic's buffer, oldest first."""
    _check_limit(limit)
    buf = recent_by_topic(arrivals.where(F.col("topic") == topic), size, order_col)
    return buf.orderBy(F.desc(order_col)).limit(min(limit, size)).orderBy(order_col)


def news_by_source(arrivals: DataFrame, source: str, size: int = BUFFER_SIZE) -> DataFrame:
    """Items of the news buffer whose source equals ``source`` ignoring case (missing source = '')."""
    buf = recent_by_topic(arrivals.where(F.col("topic") == NEWS_TOPIC), size)
    return buf.where(F.lower(F.coalesce(F.col("source"), F.lit(""))) == F.lower(F.lit(source)))


# Where each required text field of an item may stand, first truthy wins (as in ``news.normalize_news``).
_ITEM_FIELDS = {"source": ("source",), "date": ("published_date", "date"), "time": ("published_time", "time"),
                "news": ("headline", "news")}


def _item_fields(items: DataFrame) -> list[Column]:
    return [F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in names if c in items.columns], F.lit(None)).alias(field)
            for field, names in _ITEM_FIELDS.items()]


def api_news(items: DataFrame) -> DataFrame:
    """``NewsItem`` rows: the four required text fields (normalised), rows lacking one dropped."""
    return items.select(*_item_fields(items)).where(_all_present(_ITEM_FIELDS))


def api_processed(items: DataFrame) -> DataFrame:
    """``ProcessedNews`` rows: four required fields (normalised) plus the optional match fields."""
    opt = ["matched_market", "matched_market_id", "matched_market_question", "match_score"]
    return items.select(*_item_fields(items), *opt).where(_all_present(_ITEM_FIELDS))


def _all_present(cols):
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


# --------------------------------------------------------------------------- statistics

def market_stats(markets: DataFrame, market_embeddings: DataFrame) -> DataFrame:
    """Totals over markets left-joined with vectors; a NULL flag counts as neither active nor resolved."""
    me = market_embeddings.select(F.col("market_id").alias("me_market_id"))
    j = markets.select("id", "is_resolved").join(me, F.col("id") == F.col("me_market_id"), "left")
    return j.agg(F.count(F.lit(1)).alias("total_markets"),
                 F.count_if(F.col("is_resolved") == F.lit(False)).alias("active_markets"),
                 F.count_if(F.col("is_resolved") == F.lit(True)).alias("resolved_markets"),
                 F.count_distinct("me_market_id").alias("markets_with_embeddings"))


def buffer_stats(arrivals: DataFrame, cap: int = BUFFER_SIZE) -> DataFrame:
    """Buffer totals (each at most ``cap``), processing rate in percent (2 dp, 0.0 without news), latest times."""
    n_news = F.least(F.count_if(F.col("topic") == NEWS_TOPIC), F.lit(cap))
    n_proc = F.least(F.count_if(F.col("topic") == PROCESSED_TOPIC), F.lit(cap))
    rate = F.coalesce(F.round(F.try_divide(n_proc * F.lit(100.0), n_news), 2), F.lit(0.0))

    def latest(topic: str) -> Column:
        return F.max_by("time", F.when(F.col("topic") == topic, F.col("arrival")))
    return arrivals.agg(n_news.cast("long").alias("total_news"), n_proc.cast("long").alias("total_processed"),
                        rate.alias("processing_rate"), latest(NEWS_TOPIC).alias("latest_news_time"),
                        latest(PROCESSED_TOPIC).alias("latest_processed_time"))


def combined_stats(arrivals: DataFrame, markets: DataFrame, market_embeddings: DataFrame,
                   cap: int = BUFFER_SIZE) -> DataFrame:
    """Buffer statistics with the market statistics nested as ``markets``.

    Each input is aggregated on its own (the log in one hash pass, without a
    sort); the two one-row results are put together by a final aggregate.
    """
    left = buffer_stats(arrivals, cap)
    right = market_stats(markets, market_embeddings).select(F.struct("*").alias("markets"))
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def table_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and row count, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --------------------------------------------------------------------------- delta feed

def delta_feed(arrivals: DataFrame, since: DataFrame, max_items: int = DELTA_MAX_ITEMS) -> DataFrame:
    """Items that arrived after each topic's ``last_arrival``: at most ``max_items`` newest per topic.

    ``since(topic, last_arrival)`` is the previous tick's position (one row per
    topic, broadcast). A topic that did not grow sends nothing.
    """
    # one row per topic: broadcast once that is checked, else an ordinary join
    small = since.limit(MAX_BROADCAST_TOPICS + 1).count() <= MAX_BROADCAST_TOPICS
    pos = F.broadcast(since) if small else since
    new = arrivals.join(pos, "topic").where(F.col("arrival") > F.col("last_arrival")).drop("last_arrival")
    return top_n_per_key(new, "topic", "arrival", max_items)
