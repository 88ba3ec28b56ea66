"""Inputs derived by Spark from the driver tables, and the same definitions as SQL CTEs.

Texts are used whole (headlines, questions and message bodies are full
documents); ``% n`` expressions only assign each row a role (catalogue or
news, message shape, missing field), so every row of the source tables is
used and no query works on a subset. Markets and news with stored vectors
exist for the rows of ``embeddings``; messages and the feed cover every
document.

No data of the kind is given; these views turn the given tables into its record
shapes (markets with vectors, news with vectors, raw JSON messages, a market
feed, topic arrivals). Each view is written twice - DataFrame code for the
Spark side and a CTE for the DuckDB oracle - and every query's work grows with
the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semjoin.functions.jsonio import to_json_text

# Fixed fixture parameters (shared by the Spark views and the SQL CTEs).
FX_DIM = 64                 # vector length of the driver's embeddings table
FX_THRESHOLD = 0.3          # correctness threshold: 0.5 matches nothing at sf0.01
FX_BAD_DATE = "2024-13-01"
FX_TOKENS = r"[\p{L}\p{N}]+"   # what is taken out of a text to leave one the embedder cannot embed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), "text", "source")
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("vec_id"), "ts")
    return (e.join(d, "vec_id", "left").join(ev, "vec_id", "left")
            .select("vec_id", "label", "embedding",
                    F.coalesce("text", F.concat(F.lit("item "), F.col("vec_id").cast("string"))).alias("text"),
                    F.coalesce("source", F.lit("src0")).alias("source"),
                    F.coalesce("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts")))


def fx_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue: every fifth vector; resolved when label is 8 or 9."""
    b = base(spark, sf_dir).where(F.col("vec_id") % 5 == 0)
    return b.select(F.col("vec_id").alias("id"), F.lit("catalog").alias("source"),
                    F.concat(F.lit("market-"), F.col("vec_id").cast("string")).alias("slug"),
                    F.col("text").alias("question"),
                    F.col("label").isin(8, 9).alias("is_resolved"),
                    F.col("ts").alias("created_at"), F.col("ts").alias("updated_at"), "embedding")


def fx_market_rows(spark, sf_dir) -> DataFrame:
    return fx_markets(spark, sf_dir).drop("embedding")


def fx_market_embeddings(spark, sf_dir) -> DataFrame:
    return fx_markets(spark, sf_dir).select(F.col("id").alias("market_id"), "embedding",
                                            F.col("created_at"))


def fx_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored news with vectors: the other four fifths."""
    b = base(spark, sf_dir).where(F.col("vec_id") % 5 != 0)
    return b.select(F.col("vec_id").alias("news_id"), "source",
                    F.col("ts").cast("date").alias("published_date"),
                    F.substring(F.col("ts").cast("string"), 12, 8).alias("published_time"),
                    F.col("text").alias("headline"), "embedding")


def fx_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market feed rows, one per document: recurring slugs (last wins), a hot slug, new slugs, empty slugs, null questions and flags."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    vid = F.col("doc_id")
    slug = (F.when(vid % 17 == 0, F.lit(""))
            .when(vid % 7 == 1, F.lit("market-10"))
            .when(vid % 4 == 3, F.concat(F.lit("new-"), F.floor(vid / 8).cast("string")))
            .otherwise(F.concat(F.lit("market-"), (F.floor(vid / 6) * 5).cast("string"))))
    return d.select(vid.alias("pos"), slug.alias("market_slug"), (vid % 3 == 0).alias("slug_key"),
                    F.when(vid % 13 == 0, F.lit(None).cast("string"))
                     .otherwise(F.col("text")).alias("question"),
                    F.when(vid % 10 == 9, F.lit(True)).when(vid % 10 == 0, F.lit(None).cast("boolean"))
                     .otherwise(F.lit(False)).alias("closed"),
                    (vid % 19 == 0).alias("null_flag"))


FEED_SNAPSHOT_ROWS = 100
FEED_LIMIT = 80              # of the one query that is about the limit; the others take whole snapshots


def fx_feed_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed snapshots of 100 rows as JSON documents: a bare array, ``{"data": [...]}`` or ``{"markets": [...]}``.

    Each snapshot is one bounded group (100 rows), so building it never gathers
    more than one snapshot in a task.
    """
    f = fx_feed(spark, sf_dir)
    v = lambda c: F.col(c).cast("variant")
    entries = F.map_from_arrays(
        F.array(*[F.lit(k) for k in ("market_slug", "slug", "question", "closed", "is_resolved")]),
        F.array(v("market_slug"), v("market_slug"), v("question"), v("closed"), F.parse_json(F.lit("null"))))
    keep = F.map_filter(entries, lambda k, _x: (
        ((k == "market_slug") & ~F.col("slug_key")) | ((k == "slug") & F.col("slug_key"))
        | k.isin("question", "closed") | ((k == "is_resolved") & F.col("null_flag"))))
    rows = f.select((F.col("pos") / FEED_SNAPSHOT_ROWS).cast("long").alias("snap"), "pos",
                    to_json_text(keep).alias("j"))
    docs = rows.groupBy("snap").agg(F.array_sort(F.collect_list(F.struct("pos", "j"))).alias("items"))
    arr = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["j"]), ","), F.lit("]"))
    value = (F.when(F.col("snap") % 3 == 0, arr)
             .when(F.col("snap") % 3 == 1, F.concat(F.lit('{"data": '), arr, F.lit("}")))
             .otherwise(F.concat(F.lit('{"markets": '), arr, F.lit("}"))))
    return docs.select("snap", value.alias("value"))


def fx_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrival log of the two topics, one item per event; purchases are the processed (matched) items."""
    ev = table(spark, sf_dir, "events")
    proc = F.col("event_type") == "purchase"
    uid = F.col("user_id")
    return ev.select(F.when(proc, F.lit("processed_news")).otherwise(F.lit("news_stream")).alias("topic"),
                     F.col("event_id").alias("arrival"),
                     F.when(uid % 23 == 0, F.lit(None).cast("string"))
                      .otherwise(F.concat(F.lit("Src"), (uid % 20).cast("string"))).alias("source"),
                     F.col("ts").cast("date").cast("string").alias("date"),
                     F.substring(F.col("ts").cast("string"), 12, 8).alias("time"),
                     F.concat(F.col("event_type"), F.lit(" "), F.col("props")).alias("news"),
                     F.when(proc, F.concat(F.lit("market-"), ((uid % 50) * 10).cast("string"))).alias("matched_market"),
                     F.when(proc, (uid % 50) * 10).cast("long").alias("matched_market_id"),
                     F.when(proc, F.concat(F.lit("question "), (uid % 50).cast("string")))
                      .alias("matched_market_question"),
                     F.when(proc, F.col("value")).alias("match_score"))


def fx_raw_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The column values the raw messages are made of (one per document)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    ev = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "ts")
    j = d.join(ev, "doc_id", "left").withColumn(
        "ts", F.coalesce("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    body = F.when(F.col("doc_id") % 11 == 0, F.regexp_replace("text", FX_TOKENS, "-")).otherwise(F.col("text"))
    tm = F.substring(F.col("ts").cast("string"), 12, 8)
    return j.select("doc_id", (F.col("doc_id") % 8).cast("int").alias("k"),
                    F.col("source").alias("src"),
                    F.col("ts").cast("date").cast("string").alias("dt"),
                    F.when(F.col("doc_id") % 13 == 1, F.substring(tm, 1, 5)).when(F.col("doc_id") % 13 == 2, F.concat(tm, F.lit(".250")))
                     .otherwise(tm).alias("tm"),
                    body.alias("body"))


def fx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw message per document, around its whole text; eight shapes chosen by ``doc_id % 8``.

    Shapes 0 (an object that is never closed) and 1 (an array) are no JSON
    objects; 2 to 7 are, with the text as headline, news or (6) a note beside a
    missing news.
    """
    c = fx_raw_columns(spark, sf_dir)
    src, dt, tm, body = F.col("src"), F.col("dt"), F.col("tm"), F.col("body")
    null_s = F.lit(None).cast("string")

    def obj(**kw):
        return to_json_text(F.struct(*[v.alias(k) for k, v in kw.items()]))

    value = (F.when(F.col("k") == 0, F.concat(F.lit('{"news": '), F.translate(body, "\n\r", "  ")))
             .when(F.col("k") == 1, to_json_text(F.array(body)))
             .when(F.col("k") == 2, obj(source=src, date=dt, time=tm, headline=F.lit(""), news=body))
             .when(F.col("k") == 3, obj(date=dt, time=tm, news=body))
             .when(F.col("k") == 4, obj(source=src, published_date=dt, published_time=tm, headline=body,
                                        tags=F.struct(F.lit(1).alias("k"))))
             .when(F.col("k") == 5, obj(source=src, date=F.lit(FX_BAD_DATE), time=tm, news=body))
             .when(F.col("k") == 6, obj(source=src, date=dt, time=tm, news=null_s, note=body))
             .otherwise(obj(source=src, date=dt, time=tm, news=body)))
    return c.select(F.col("doc_id").alias("msg_id"), value.alias("value"))


# --------------------------------------------------------------------------- SQL twins for the oracle

SQL_BASE = """
base AS (
  SELECT e.vec_id, e.label, CAST(e.embedding AS DOUBLE[]) AS embedding,
         coalesce(d.text, concat('item ', CAST(e.vec_id AS VARCHAR))) AS text,
         coalesce(d.source, 'src0') AS source,
         coalesce(ev.ts, TIMESTAMP '2024-01-01 00:00:00') AS ts
  FROM embeddings e
  LEFT JOIN documents d ON d.doc_id = e.vec_id
  LEFT JOIN events ev ON ev.event_id = e.vec_id)"""

SQL_MARKETS = """
fx_markets AS (
  SELECT vec_id AS id, 'catalog' AS source, concat('market-', CAST(vec_id AS VARCHAR)) AS slug,
         text AS question, label IN (8, 9) AS is_resolved,
         ts AS created_at, ts AS updated_at, embedding
  FROM base WHERE vec_id % 5 = 0)"""

SQL_NEWS = """
fx_news AS (
  SELECT vec_id AS news_id, source, CAST(ts AS DATE) AS published_date,
         substring(CAST(ts AS VARCHAR), 12, 8) AS published_time,
         text AS headline, embedding
  FROM base WHERE vec_id % 5 <> 0)"""

SQL_FEED = """
fx_feed AS (
  SELECT doc_id AS pos,
         CASE WHEN doc_id % 17 = 0 THEN '' WHEN doc_id % 7 = 1 THEN 'market-10'
              WHEN doc_id % 4 = 3 THEN concat('new-', CAST(doc_id // 8 AS VARCHAR))
              ELSE concat('market-', CAST((doc_id // 6) * 5 AS VARCHAR)) END AS market_slug,
         doc_id % 3 = 0 AS slug_key,
         CASE WHEN doc_id % 13 = 0 THEN NULL ELSE text END AS question,
         CASE WHEN doc_id % 10 = 9 THEN TRUE WHEN doc_id % 10 = 0 THEN NULL ELSE FALSE END AS closed,
         doc_id % 19 = 0 AS null_flag
  FROM documents),
fx_feed_rows AS (
  SELECT pos, pos // 100 AS snap, pos % 100 AS idx, nullif(market_slug, '') AS slug, nullif(question, '') AS question,
         CASE WHEN closed THEN TRUE WHEN null_flag THEN NULL ELSE FALSE END AS is_resolved
  FROM fx_feed)"""

SQL_ARRIVALS = """
fx_arrivals AS (
  SELECT CASE WHEN event_type = 'purchase' THEN 'processed_news' ELSE 'news_stream' END AS topic,
         event_id AS arrival,
         CASE WHEN user_id % 23 = 0 THEN NULL ELSE concat('Src', CAST(user_id % 20 AS VARCHAR)) END AS source,
         CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
         substring(CAST(ts AS VARCHAR), 12, 8) AS time,
         concat(event_type, ' ', props) AS news,
         CASE WHEN event_type = 'purchase' THEN concat('market-', CAST((user_id % 50) * 10 AS VARCHAR)) END
           AS matched_market,
         CASE WHEN event_type = 'purchase' THEN CAST((user_id % 50) * 10 AS BIGINT) END AS matched_market_id,
         CASE WHEN event_type = 'purchase' THEN concat('question ', CAST(user_id % 50 AS VARCHAR)) END
           AS matched_market_question,
         CASE WHEN event_type = 'purchase' THEN value END AS match_score
  FROM events)"""

SQL_RAW = f"""
raw_ts AS (
  SELECT d.doc_id, d.source, d.text, coalesce(ev.ts, TIMESTAMP '2024-01-01 00:00:00') AS ts
  FROM documents d LEFT JOIN events ev ON ev.event_id = d.doc_id),
raw_cols AS (
  SELECT doc_id, CAST(doc_id % 8 AS INTEGER) AS k, source AS src, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt,
         substring(CAST(ts AS VARCHAR), 12, 8) AS clock,
         CASE WHEN doc_id % 13 = 1 THEN substring(CAST(ts AS VARCHAR), 12, 5)
              WHEN doc_id % 13 = 2 THEN concat(substring(CAST(ts AS VARCHAR), 12, 8), '.250')
              ELSE substring(CAST(ts AS VARCHAR), 12, 8) END AS tm,
         CASE WHEN doc_id % 11 = 0 THEN regexp_replace(text, '{FX_TOKENS}', '-', 'g') ELSE text END AS body
  FROM raw_ts),
fx_raw AS (
  SELECT doc_id AS msg_id, k, k IN (0, 1) AS bad, body,
         CASE WHEN k IN (2,4,5,6,7) THEN src END AS source,
         CASE WHEN k = 5 THEN '{FX_BAD_DATE}' WHEN k IN (2,3,4,6,7) THEN dt END AS published_date,
         CASE WHEN k IN (2,3,4,5,6,7) THEN tm END AS published_time,
         CASE WHEN doc_id % 13 = 1 THEN concat(tm, ':00') WHEN doc_id % 13 = 2 THEN concat(clock, '.25') ELSE tm END AS stored_time,
         CASE WHEN k IN (2,3,4,5,7) THEN nullif(body, '') END AS headline,
         k = 4 AS has_tags
  FROM raw_cols)"""


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding the requested fixture CTEs (dependencies first)."""
    parts = []
    wanted = set(names)
    if wanted & {"fx_markets", "fx_news"}:
        parts.append(SQL_BASE)
    for n, sql in (("fx_markets", SQL_MARKETS), ("fx_news", SQL_NEWS), ("fx_feed", SQL_FEED),
                   ("fx_arrivals", SQL_ARRIVALS), ("fx_raw", SQL_RAW)):
        if n in wanted:
            parts.append(sql)
    return "WITH " + ",".join(parts)
