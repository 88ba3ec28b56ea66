"""News records: parse, normalise, type, embed, match and classify.

A raw message is JSON text. It becomes a ``record`` map (open schema, unknown
keys kept) plus typed columns read from it, then gets the embedding and match
columns and the two statuses the store and the publisher act on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from semjoin.functions.jsonio import drop_keys, parse_json_object, truthy_text
from semjoin.operators.partitioning import spread

# Keys the processing step writes into a record, and the statuses it reports.
RESERVED_KEYS = ("embedding", "embedding_dim", "embedding_status", "matched_market", "matched_market_id",
                 "matched_market_question", "match_score", "news_id", "db_status")
EMBED_NO_TEXT, EMBED_FAILED, EMBED_SUCCESS = "no_text", "failed", "success"
DB_MISSING, DB_NO_EMBEDDING, DB_SAVED = "failed_missing_fields", "failed_no_embedding", "saved"
DB_BAD_DATE, DB_BAD_TIME = "failed: bad date", "failed: bad time"

DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
TIME_PATTERN = r"^([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?$"


def parse_news(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Keep messages that are JSON objects; adds ``record`` (reserved keys removed)."""
    rec = parse_json_object(F.col(value_col))
    # a generated column: the optimizer would parse every message once more in the filter, below the spread
    parsed = spread(raw).select("*", F.explode(F.array(drop_keys(rec, RESERVED_KEYS))).alias("record"))
    return parsed.where(F.col("record").isNotNull())


def bad_records(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """The complement of ``parse_news``: messages to log and skip."""
    return raw.where(parse_json_object(F.col(value_col)).isNull())


def field(name: str) -> Column:
    return truthy_text(F.col("record")[name])


def headline() -> Column:
    """First truthy of ``headline``, ``news``."""
    return F.coalesce(field("headline"), field("news"))


def normalize_news(parsed: DataFrame) -> DataFrame:
    """Adds ``source``, ``published_date``, ``published_time`` (text) and ``headline``."""
    return (parsed.withColumn("source", field("source"))
                  .withColumn("published_date", F.coalesce(field("published_date"), field("date")))
                  .withColumn("published_time", F.coalesce(field("published_time"), field("time")))
                  .withColumn("headline", headline()))


def date_value(c: Column) -> Column:
    """ISO ``YYYY-MM-DD`` text to DATE; anything else (or an impossible date) -> NULL."""
    return F.when(c.rlike(DATE_PATTERN), F.try_to_date(c, "yyyy-MM-dd"))


def time_ok(c: Column) -> Column:
    return F.coalesce(c.rlike(TIME_PATTERN), F.lit(False))


def time_value(c: Column) -> Column:
    """A time as the store keeps it, to the microsecond: ``HH:MM:SS`` plus the fraction without trailing zeros; else NULL."""
    full = F.when(F.length(c) == 5, F.concat(c, F.lit(":00"))).otherwise(c)
    short = F.rtrim(F.rtrim(full, F.lit("0")), F.lit("."))
    return F.when(time_ok(c), F.when(full.contains("."), short).otherwise(full))


def typed_datetime(df: DataFrame) -> DataFrame:
    """Adds ``pub_date`` (DATE) and ``time_valid``: the store's column types as checks."""
    return (df.withColumn("pub_date", date_value(F.col("published_date")))
              .withColumn("time_valid", time_ok(F.col("published_time"))))


def required_present() -> Column:
    return (F.col("source").isNotNull() & F.col("published_date").isNotNull()
            & F.col("published_time").isNotNull() & F.col("headline").isNotNull())


def embed_news(df: DataFrame, embedder) -> DataFrame:
    """Adds ``embedding``, ``embedding_dim`` and ``embedding_status``."""
    text = F.col("headline")
    out = df.withColumn("embedding", F.when(text.isNotNull(), embedder(text)))
    status = (F.when(text.isNull(), F.lit(EMBED_NO_TEXT))
              .when(F.col("embedding").isNull(), F.lit(EMBED_FAILED))
              .otherwise(F.lit(EMBED_SUCCESS)))
    return (out.withColumn("embedding_status", status)
               .withColumn("embedding_dim", F.when(F.col("embedding").isNotNull(), F.size("embedding"))))


def store_status(df: DataFrame) -> DataFrame:
    """Adds ``db_status``; the checks run in the store's order."""
    d = date_value(F.col("published_date"))
    st = (F.when(~required_present(), F.lit(DB_MISSING))
          .when(F.col("embedding").isNull(), F.lit(DB_NO_EMBEDDING))
          .when(d.isNull(), F.lit(DB_BAD_DATE))
          .when(~time_ok(F.col("published_time")), F.lit(DB_BAD_TIME))
          .otherwise(F.lit(DB_SAVED)))
    return df.withColumn("db_status", st)


def process(raw: DataFrame, embedder, catalogue: DataFrame, *, dim: int, threshold: float,
            value_col: str = "value", prepared=None, **match_opts) -> DataFrame:
    """parse -> normalise -> embed -> match -> enrich -> status, one DataFrame per batch.

    ``catalogue`` (id, slug, question, embedding) is measured once - or not at
    all when ``prepared`` (``match.prepare_catalogue`` of this catalogue) is
    given; callers running several actions should persist it for the
    duration of the batch.
    """
    from semjoin.operators import match as M
    if prepared is None and match_opts.get("strategy", "auto") != "blocked":
        opts = {k: match_opts[k] for k in ("max_broadcast_bytes", "strategy", "nlist", "seed") if k in match_opts}
        prepared = M.prepare_catalogue(catalogue, dim, **opts)
    parsed = normalize_news(parse_news(raw, value_col))
    emb = embed_news(parsed, embedder)
    matched = M.nearest(emb, catalogue, dim=dim, threshold=threshold, prepared=prepared, **match_opts)
    if prepared is None:
        return store_status(M.enrich(matched, catalogue))
    return store_status(M.enrich(matched, prepared.catalogue, text_bytes=prepared.text_bytes))


def status_counts(processed: DataFrame) -> DataFrame:
    """Records per (``embedding_status``, ``db_status``): what a run did with its messages."""
    return processed.groupBy("embedding_status", "db_status").agg(F.count(F.lit(1)).alias("n"))


# Every pair of statuses a record can have, as (embedding_status, db_status).
_STATUSES = [(e, d) for e in (EMBED_NO_TEXT, EMBED_FAILED, EMBED_SUCCESS) for d in (DB_MISSING, DB_NO_EMBEDDING, DB_BAD_DATE, DB_BAD_TIME, DB_SAVED)]


def observed_statuses(processed: DataFrame) -> tuple[DataFrame, Observation]:
    """``processed`` and an observation that counts its statuses in the pass that first reads it, without one of its own."""
    seen = Observation()
    counts = [F.count_if((F.col("embedding_status") == e) & (F.col("db_status") == d)).alias(f"s{i}") for i, (e, d) in enumerate(_STATUSES)]
    return processed.observe(seen, *counts), seen


def status_rows(seen: Observation) -> list[tuple[str, str, int]]:
    """What ``status_counts`` gives, from an observation whose pass is over."""
    return [(*pair, n) for i, pair in enumerate(_STATUSES) if (n := seen.get.get(f"s{i}") or 0)]
