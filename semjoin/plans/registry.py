"""The query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator, plus SQL oracles.

Keys follow the operator inventory. Every query reads the driver tables (or
views Spark derives from them) in full; the oracle text computes the same
answer in DuckDB from the *columns* of the fixture views, never by re-parsing
our own outputs.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semjoin.functions import vectors as V
from semjoin.operators import match as M
from semjoin.plans import fixtures as X
from semjoin.plans.fixtures import FX_DIM, FX_THRESHOLD, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(c, 6)


# =========================================================================== matching

def _catalogue(spark, sf):
    return M.match_catalogue(X.fx_market_rows(spark, sf), X.fx_market_embeddings(spark, sf))


_SQL_CAT = """,
cat AS (SELECT id, slug, question, embedding FROM fx_markets WHERE is_resolved = false AND embedding IS NOT NULL),
sims AS (SELECT n.news_id, c.id AS market_id, list_cosine_similarity(n.embedding, c.embedding) AS sim
         FROM fx_news n CROSS JOIN cat c),
top AS (SELECT news_id, market_id, sim FROM (
          SELECT *, row_number() OVER (PARTITION BY news_id ORDER BY round(sim, 12) DESC, market_id) AS rn
          FROM sims) WHERE rn = 1)"""


@query("match_top1", with_ctes("fx_markets", "fx_news") + _SQL_CAT + """
SELECT n.news_id, t.market_id, round(t.sim, 6) AS similarity
FROM fx_news n LEFT JOIN top t USING (news_id)""")
def q_match_top1(spark, sf):
    m = M.nearest(X.fx_news(spark, sf), _catalogue(spark, sf), dim=FX_DIM, threshold=None)
    return m.select("news_id", F.col("matched_market_id").alias("market_id"), r6("match_score").alias("similarity"))


@query("match_threshold", with_ctes("fx_markets", "fx_news") + _SQL_CAT + f"""
SELECT news_id, market_id, round(sim, 6) AS similarity FROM top WHERE sim >= {FX_THRESHOLD}""")
def q_match_threshold(spark, sf):
    m = M.nearest(X.fx_news(spark, sf), _catalogue(spark, sf), dim=FX_DIM, threshold=FX_THRESHOLD)
    return (m.where(F.col("matched_market_id").isNotNull())
             .select("news_id", F.col("matched_market_id").alias("market_id"), r6("match_score").alias("similarity")))


_ENRICH_COLS = ["news_id", "source", "published_date", "published_time", "headline",
                "matched_market", "matched_market_id", "matched_market_question", "match_score"]


def _enriched(spark, sf):
    cat = _catalogue(spark, sf)
    ready = M.prepare_catalogue(cat, FX_DIM)
    m = M.nearest(X.fx_news(spark, sf), cat, dim=FX_DIM, threshold=FX_THRESHOLD, prepared=ready)
    return M.enrich(m, ready.catalogue, text_bytes=ready.text_bytes)


_SQL_ENRICH = _SQL_CAT + f""",
enriched AS (
  SELECT n.news_id, n.source, n.published_date, n.published_time, n.headline,
         c.slug AS matched_market, c.id AS matched_market_id, c.question AS matched_market_question,
         round(t.sim, 6) AS match_score
  FROM fx_news n LEFT JOIN top t ON t.news_id = n.news_id AND t.sim >= {FX_THRESHOLD}
  LEFT JOIN cat c ON c.id = t.market_id)"""


@query("match_enrich", with_ctes("fx_markets", "fx_news") + _SQL_ENRICH + " SELECT * FROM enriched")
def q_match_enrich(spark, sf):
    return _enriched(spark, sf).withColumn("match_score", r6("match_score")).select(*_ENRICH_COLS)


@query("matched_only", with_ctes("fx_markets", "fx_news") + _SQL_ENRICH
       + " SELECT * FROM enriched WHERE matched_market IS NOT NULL")
def q_matched_only(spark, sf):
    e = _enriched(spark, sf).withColumn("match_score", r6("match_score")).select(*_ENRICH_COLS)
    return e.where(F.col("matched_market").isNotNull())


@query("match_empty_catalog", with_ctes("fx_news") + """
SELECT news_id, CAST(NULL AS BIGINT) AS matched_market_id, CAST(NULL AS DOUBLE) AS match_score
FROM fx_news""")
def q_match_empty_catalog(spark, sf):
    # the real catalogue with every market resolved: nothing to search -> no match, no error
    markets = X.fx_market_rows(spark, sf).withColumn("is_resolved", F.lit(True))
    cat = M.match_catalogue(markets, X.fx_market_embeddings(spark, sf))
    m = M.nearest(X.fx_news(spark, sf), cat, dim=FX_DIM, threshold=FX_THRESHOLD)
    return m.select("news_id", "matched_market_id", "match_score")


@query("match_blocked", with_ctes("fx_markets", "fx_news") + _SQL_CAT + """
SELECT n.news_id, t.market_id, round(t.sim, 6) AS similarity
FROM fx_news n LEFT JOIN top t USING (news_id)""")
def q_match_blocked(spark, sf):
    # the beyond-the-broadcast-budget strategy, forced
    m = M.nearest(X.fx_news(spark, sf), _catalogue(spark, sf), dim=FX_DIM, threshold=None, strategy="blocked")
    return m.select("news_id", F.col("matched_market_id").alias("market_id"), r6("match_score").alias("similarity"))


@query("match_bounded", with_ctes("fx_markets", "fx_news") + _SQL_CAT + f"""
SELECT n.news_id, t.market_id, round(t.sim, 6) AS similarity
FROM fx_news n LEFT JOIN top t ON t.news_id = n.news_id AND t.sim >= {FX_THRESHOLD}""")
def q_match_bounded(spark, sf):
    # beyond the broadcast budget, in lists of about 64 markets: only pairs that can reach the threshold are shuffled
    m = M.nearest(X.fx_news(spark, sf), _catalogue(spark, sf), dim=FX_DIM, threshold=FX_THRESHOLD, strategy="bounded", cat_block_rows=64)
    return m.select("news_id", F.col("matched_market_id").alias("market_id"), r6("match_score").alias("similarity"))


@query("match_ivf_full_probe", with_ctes("fx_markets", "fx_news") + _SQL_CAT + """
SELECT n.news_id, t.market_id, round(t.sim, 6) AS similarity
FROM fx_news n LEFT JOIN top t USING (news_id)""")
def q_match_ivf_full_probe(spark, sf):
    m = M.nearest(X.fx_news(spark, sf), _catalogue(spark, sf), dim=FX_DIM, threshold=None,
                  strategy="ivf", nlist=8, nprobe=8)
    return m.select("news_id", F.col("matched_market_id").alias("market_id"), r6("match_score").alias("similarity"))


@query("match_ivf", with_ctes("fx_markets", "fx_news") + _SQL_CAT + """
SELECT n.news_id, t.market_id, round(t.sim, 6) AS similarity
FROM fx_news n LEFT JOIN top t USING (news_id)""")
def q_match_ivf(spark, sf):
    # the index's 200 lists, searched round by round until no list can hold a better match
    m = M.nearest(X.fx_news(spark, sf), _catalogue(spark, sf), dim=FX_DIM, threshold=None, strategy="ivf")
    return m.select("news_id", F.col("matched_market_id").alias("market_id"), r6("match_score").alias("similarity"))


@query("match_ivf_recall", "SELECT true AS enough")
def q_match_ivf_recall(spark, sf):
    # three rounds only (8 + 32 + 128 of 200 lists, less those that cannot help): the share of exact answers among them
    news, cat = X.fx_news(spark, sf), _catalogue(spark, sf)
    exact = M.nearest(news, cat, dim=FX_DIM, threshold=None).select("news_id", F.round("match_score", 9).alias("want"))
    found = M.nearest(news, cat, dim=FX_DIM, threshold=None, strategy="ivf", rounds=3).select("news_id", F.round("match_score", 9).alias("got"))
    hit = F.avg((F.col("want") <= F.col("got")).cast("double"))
    return exact.join(found, "news_id").agg((F.coalesce(hit, F.lit(1.0)) >= 0.9).alias("enough"))


@query("market_vectors", with_ctes("fx_markets") + """
SELECT m.id, m.slug, m.is_resolved, len(me.embedding) AS dim
FROM (SELECT id, slug, is_resolved FROM fx_markets) m
JOIN (SELECT id AS market_id, embedding FROM fx_markets WHERE id % 3 <> 0) me ON m.id = me.market_id""")
def q_market_vectors(spark, sf):
    # markets and their vectors as two tables; one third of the vectors missing
    markets = X.fx_market_rows(spark, sf).select("id", "slug", "is_resolved")
    vecs = X.fx_market_embeddings(spark, sf).where(F.col("market_id") % 3 != 0)
    j = M.market_vectors(markets, vecs)
    return j.select("id", "slug", "is_resolved", F.size("embedding").alias("dim"))


@query("active_markets", with_ctes("fx_markets") + """
SELECT id, slug FROM (
  SELECT id, slug, CASE WHEN id % 7 = 0 THEN NULL ELSE is_resolved END AS is_resolved FROM fx_markets)
WHERE is_resolved = false""")
def q_active_markets(spark, sf):
    m = X.fx_market_rows(spark, sf).withColumn(
        "is_resolved", F.when(F.col("id") % 7 == 0, F.lit(None).cast("boolean")).otherwise(F.col("is_resolved")))
    return M.active_markets(m).select("id", "slug")


_SQL_PAIRS = """,
pairs AS (SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS a, CAST(b.embedding AS DOUBLE[]) AS b
          FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


def _pairs(spark, sf):
    e = X.table(spark, sf, "embeddings").select("vec_id", "embedding")
    b = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return e.withColumnRenamed("embedding", "a").join(b, "vec_id")


@query("cosine_similarity", "WITH x AS (SELECT 1)" + _SQL_PAIRS + """
SELECT vec_id, round(list_cosine_similarity(a, b), 6) AS similarity,
       round(1 - list_cosine_similarity(a, b), 6) AS distance
FROM pairs""")
def q_cosine_similarity(spark, sf):
    p = _pairs(spark, sf)
    return p.select("vec_id", r6(V.cosine_similarity("a", "b")).alias("similarity"),
                    r6(V.cosine_distance("a", "b")).alias("distance"))


@query("vector_norms", "WITH x AS (SELECT 1)" + _SQL_PAIRS + """
SELECT vec_id, round(list_dot_product(a, b), 6) AS dot,
       round(sqrt(list_dot_product(a, a)), 6) AS norm,
       round(list_sum(list_transform(a, lambda x: x / sqrt(list_dot_product(a, a)))), 6) AS unit_sum
FROM pairs""")
def q_vector_norms(spark, sf):
    p = _pairs(spark, sf)
    unit = V.normalize("a")
    return p.select("vec_id", r6(V.dot("a", "b")).alias("dot"), r6(V.l2_norm("a")).alias("norm"),
                    r6(F.aggregate(unit, F.lit(0.0), lambda acc, x: acc + x)).alias("unit_sum"))


# =========================================================================== parsing, normalising, statuses

from semjoin.operators import embed as EMB  # noqa: E402
from semjoin.operators import news as N  # noqa: E402
from semjoin.operators import vector_store as VS  # noqa: E402


def hash_sql(name: str, src: str, id_col: str, text_col: str, dim: int = FX_DIM) -> str:
    """Sparse hashed bag-of-tokens vectors in SQL: ``{name}_vec(id, bucket, v FLOAT)``."""
    return f""",
{name}_tok AS (SELECT {id_col} AS id, lower(unnest(regexp_extract_all({text_col}, '{EMB.TOKEN_PATTERN}'))) AS tok
               FROM {src}),
{name}_cnt AS (SELECT id, CAST(('0x' || substr(md5(tok), 1, {EMB.HASH_HEX_CHARS})) AS BIGINT) % {dim} AS bucket,
                      count(*) AS c FROM {name}_tok GROUP BY 1, 2),
{name}_vec AS (SELECT id, bucket, CAST(c / sqrt(sum(c * c) OVER (PARTITION BY id)) AS FLOAT) AS v FROM {name}_cnt)"""


def _embedder():
    return EMB.HashEmbedder(FX_DIM)


def _parsed(spark, sf):
    return N.normalize_news(N.parse_news(X.fx_raw(spark, sf)))


_SQL_RAW_STATUS = f""",
raw_st AS (
  SELECT *, CASE WHEN headline IS NULL THEN 'no_text'
                 WHEN len(regexp_extract_all(headline, '{EMB.TOKEN_PATTERN}')) = 0 THEN 'failed'
                 ELSE 'success' END AS embedding_status
  FROM fx_raw WHERE NOT bad),
raw_db AS (
  SELECT *, CASE WHEN source IS NULL OR published_date IS NULL OR published_time IS NULL OR headline IS NULL
                   THEN 'failed_missing_fields'
                 WHEN embedding_status <> 'success' THEN 'failed_no_embedding'
                 WHEN NOT regexp_full_match(published_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
                      OR TRY_CAST(published_date AS DATE) IS NULL THEN 'failed: bad date'
                 ELSE 'saved' END AS db_status
  FROM raw_st)"""


@query("parse_news", with_ctes("fx_raw") + """
SELECT msg_id, CASE k WHEN 2 THEN 'date,headline,news,source,time'
                      WHEN 3 THEN 'date,news,time'
                      WHEN 4 THEN 'headline,published_date,published_time,source,tags'
                      WHEN 6 THEN 'date,news,note,source,time'
                      ELSE 'date,news,source,time' END AS keys
FROM fx_raw WHERE NOT bad""")
def q_parse_news(spark, sf):
    p = N.parse_news(X.fx_raw(spark, sf))
    return p.select("msg_id", F.array_join(F.array_sort(F.map_keys("record")), ",").alias("keys"))


@query("bad_records", with_ctes("fx_raw") + """
SELECT msg_id, CASE WHEN k = 0 THEN concat('{"news": ', replace(replace(body, chr(10), ' '), chr(13), ' '))
                    ELSE CAST(to_json([body]) AS VARCHAR) END AS value
FROM fx_raw WHERE bad""")
def q_bad_records(spark, sf):
    return N.bad_records(X.fx_raw(spark, sf)).select("msg_id", "value")


@query("headline_fallback", with_ctes("fx_raw") + "SELECT msg_id, headline FROM fx_raw WHERE NOT bad")
def q_headline_fallback(spark, sf):
    return _parsed(spark, sf).select("msg_id", "headline")


@query("normalize_news", with_ctes("fx_raw") + """
SELECT msg_id, source, published_date, published_time, headline FROM fx_raw WHERE NOT bad""")
def q_normalize_news(spark, sf):
    return _parsed(spark, sf).select("msg_id", "source", "published_date", "published_time", "headline")


@query("typed_datetime", with_ctes("fx_raw") + """
SELECT msg_id, CASE WHEN regexp_full_match(published_date, '\\d{4}-\\d{2}-\\d{2}')
                    THEN TRY_CAST(published_date AS DATE) END AS pub_date,
       coalesce(regexp_full_match(published_time, '([01]\\d|2[0-3]):[0-5]\\d(:[0-5]\\d(\\.\\d{1,6})?)?'), false)
         AS time_valid
FROM fx_raw WHERE NOT bad""")
def q_typed_datetime(spark, sf):
    return N.typed_datetime(_parsed(spark, sf)).select("msg_id", "pub_date", "time_valid")


@query("required_fields", with_ctes("fx_raw") + """
SELECT msg_id FROM fx_raw
WHERE NOT bad AND source IS NOT NULL AND published_date IS NOT NULL AND published_time IS NOT NULL
  AND headline IS NOT NULL""")
def q_required_fields(spark, sf):
    return _parsed(spark, sf).where(N.required_present()).select("msg_id")


@query("embedding_status", with_ctes("fx_raw") + _SQL_RAW_STATUS + f"""
SELECT msg_id, embedding_status, CASE WHEN embedding_status = 'success' THEN {FX_DIM} END AS embedding_dim
FROM raw_st""")
def q_embedding_status(spark, sf):
    return N.embed_news(_parsed(spark, sf), _embedder()).select("msg_id", "embedding_status", "embedding_dim")


@query("store_status", with_ctes("fx_raw") + _SQL_RAW_STATUS + """
SELECT msg_id, embedding_status, db_status FROM raw_db""")
def q_store_status(spark, sf):
    s = N.store_status(N.embed_news(_parsed(spark, sf), _embedder()))
    return s.select("msg_id", "embedding_status", "db_status")


@query("status_counts", with_ctes("fx_raw") + _SQL_RAW_STATUS + """
SELECT embedding_status, db_status, count(*) AS n FROM raw_db GROUP BY 1, 2""")
def q_status_counts(spark, sf):
    s = N.store_status(N.embed_news(_parsed(spark, sf), _embedder()))
    return N.status_counts(s)


@query("embedding_dim", """
SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN len(embedding) - 1 ELSE len(embedding) END AS embedding_dim
FROM embeddings""")
def q_embedding_dim(spark, sf):
    e = X.table(spark, sf, "embeddings")
    cut = F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, FX_DIM - 1)).otherwise(F.col("embedding"))
    return e.select("vec_id", F.size(cut).alias("embedding_dim"))


@query("vector_dim_check", f"""
SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 'rejected' ELSE 'ok' END AS status
FROM embeddings""")
def q_vector_dim_check(spark, sf):
    from semjoin.functions.vectors import text_to_vector, vector_to_text
    e = X.table(spark, sf, "embeddings")
    cut = F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, FX_DIM - 1)).otherwise(F.col("embedding"))
    back = text_to_vector(vector_to_text(cut), FX_DIM)
    return e.select("vec_id", F.when(back.isNull(), "rejected").otherwise("ok").alias("status"))


@query("vector_text_roundtrip", """
SELECT vec_id, round(list_sum(CAST(embedding AS DOUBLE[])), 5) AS total, len(embedding) AS dim FROM embeddings""")
def q_vector_text_roundtrip(spark, sf):
    from semjoin.functions.vectors import text_to_vector, vector_to_text
    e = X.table(spark, sf, "embeddings")
    back = text_to_vector(vector_to_text("embedding"), FX_DIM)
    return e.select("vec_id", F.round(F.aggregate(back, F.lit(0.0), lambda a, x: a + x.cast("double")), 5)
                    .alias("total"), F.size(back).alias("dim"))


@query("text_preview", """
SELECT doc_id, CASE WHEN length(text) > 50 THEN concat(substring(text, 1, 50), '...') ELSE text END AS preview
FROM documents""")
def q_text_preview(spark, sf):
    from semjoin.functions.text import text_preview
    return X.table(spark, sf, "documents").select("doc_id", text_preview("text").alias("preview"))


_SQL_EMBED = "WITH d AS (SELECT doc_id, text FROM documents)" + hash_sql("h", "d", "doc_id", "text") + f""",
agg AS (SELECT id, count(*) AS n_buckets, sum(CAST(v AS DOUBLE)) AS l1, sum(bucket * CAST(v AS DOUBLE)) AS weighted
             FROM h_vec GROUP BY id)
SELECT d.doc_id, len(regexp_extract_all(d.text, '{EMB.TOKEN_PATTERN}')) AS n_tokens,
       a.n_buckets, round(a.l1, 6) AS l1, round(a.weighted, 6) AS weighted
FROM d LEFT JOIN agg a ON a.id = d.doc_id"""


def _embedded(spark, sf, embedder):
    from semjoin.operators.partitioning import spread
    d = spread(X.table(spark, sf, "documents").select("doc_id", "text"))
    return _vector_sums(d.withColumn("v", embedder(F.col("text"))))


def _vector_sums(embedded):
    e = embedded.select("doc_id", F.size(F.regexp_extract_all("text", F.lit(EMB.TOKEN_PATTERN), 0)).alias("n_tokens"), "v")
    w = F.zip_with(F.sequence(F.lit(0), F.lit(FX_DIM - 1)), F.col("v"), lambda i, x: i * x.cast("double"))
    return e.select("doc_id", "n_tokens",
                    F.when(F.col("v").isNotNull(), F.size(F.filter("v", lambda x: x > 0))).cast("long").alias("n_buckets"),
                    F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double")), 6).alias("l1"),
                    F.round(F.aggregate(w, F.lit(0.0), lambda a, x: a + x), 6).alias("weighted"))


@query("embed_hash", _SQL_EMBED)
def q_embed_hash(spark, sf):
    return _embedded(spark, sf, _embedder())


@query("embed_model", _SQL_EMBED)
def q_embed_model(spark, sf):
    # the model path (loaded once per worker, requests of at most 100 texts, a time limit), with the hashing scheme as the model
    return _embedded(spark, sf, EMB.ModelEmbedder(lambda: EMB.hash_encoder(FX_DIM), FX_DIM, timeout_s=60.0))


@query("embed_stored", _SQL_EMBED)
def q_embed_stored(spark, sf):
    """Every document's vector by way of the store: the English documents first, then all, of which only the other texts are new."""
    path, docs = shared_dir(spark, "vectors-by-text"), X.table(spark, sf, "documents").select("doc_id", "text", "lang")
    VS.embed_stored(docs.where("lang = 'en'").select("doc_id", "text"), "text", _embedder(), path)
    return _vector_sums(VS.embed_stored(docs.select("doc_id", "text"), "text", _embedder(), path, "v"))


@query("embed_batches", f"""
SELECT batch, count(*) AS count, max(CASE WHEN ok THEN {FX_DIM} END) AS dimension, count(*) FILTER (WHERE ok) AS embedded
FROM (SELECT (row_number() OVER (ORDER BY doc_id) - 1) // {EMB.MAX_BATCH_TEXTS} AS batch,
             len(regexp_extract_all(text, '{EMB.TOKEN_PATTERN}')) > 0 AS ok FROM documents)
GROUP BY batch""")
def q_embed_batches(spark, sf):
    d = X.table(spark, sf, "documents").select("doc_id", "text")
    return EMB.embed_batches(d, "text", "doc_id", lambda: EMB.hash_encoder(FX_DIM))


# =========================================================================== catalogue

import datetime as _dt  # noqa: E402

from semjoin.operators import catalog as C  # noqa: E402
from semjoin.session import shared_dir  # noqa: E402
from semjoin.sources import feed as FEED  # noqa: E402

FX_NOW = _dt.datetime(2024, 2, 1, 0, 0, 0)
_SQL_NOW = "TIMESTAMP '2024-02-01 00:00:00'"


def _feed_docs(spark, sf):
    """Land the feed snapshots as files in the shared folder and read them back."""
    path = shared_dir(spark, "feed")
    FEED.write_feed(X.fx_feed_docs(spark, sf), path)
    return FEED.read_feed(spark, path)


def _feed_rows(spark, sf):
    """Every row of every snapshot, normalised."""
    return C.normalize_feed(C.feed_rows(_feed_docs(spark, sf), X.FEED_SNAPSHOT_ROWS))


def _staged(spark, sf):
    return C.ingest_status(_feed_rows(spark, sf), _embedder())


_ORDER = ["snap", "pos"]


@query("market_feed", with_ctes("fx_feed") + f"""
SELECT snap, idx AS pos, slug, question, is_resolved FROM fx_feed_rows WHERE idx < {X.FEED_LIMIT}""")
def q_market_feed(spark, sf):
    rows = C.normalize_feed(C.feed_rows(_feed_docs(spark, sf), X.FEED_LIMIT))
    return rows.select(F.col("snap").cast("long").alias("snap"), F.col("pos").cast("long").alias("pos"),
                       "slug", "question", "is_resolved")


@query("market_feed_valid", with_ctes("fx_feed") + """
SELECT snap, idx AS pos, slug FROM fx_feed_rows WHERE slug IS NOT NULL AND question IS NOT NULL""")
def q_market_feed_valid(spark, sf):
    rows = _feed_rows(spark, sf).where(C.feed_valid())
    return rows.select(F.col("snap").cast("long").alias("snap"), F.col("pos").cast("long").alias("pos"), "slug")


@query("market_normalize", with_ctes("fx_feed") + f"""
SELECT snap, idx AS pos, slug, is_resolved, '{C.DEFAULT_SOURCE_TAG}' AS source FROM fx_feed_rows""")
def q_market_normalize(spark, sf):
    rows = _feed_rows(spark, sf)
    return rows.select(F.col("snap").cast("long").alias("snap"), F.col("pos").cast("long").alias("pos"),
                       "slug", "is_resolved", "source")


_SQL_STAGED = f""",
staged AS (
  SELECT r.*, snap * 100 + idx AS ord,
         CASE WHEN slug IS NULL OR question IS NULL THEN 'invalid'
              WHEN len(regexp_extract_all(question, '{EMB.TOKEN_PATTERN}')) = 0 THEN 'no_embedding'
              ELSE 'ok' END AS status
  FROM fx_feed_rows r),
last AS (
  SELECT slug, question, is_resolved, first_ord FROM (
    SELECT slug, question, is_resolved, min(ord) OVER (PARTITION BY slug) AS first_ord,
           row_number() OVER (PARTITION BY slug ORDER BY ord DESC) AS rn
    FROM staged WHERE status = 'ok') WHERE rn = 1),
cur AS (SELECT id, source, slug, question, is_resolved, created_at, updated_at FROM fx_markets),
upserted AS (
  SELECT c.id, c.source, c.slug, coalesce(l.question, c.question) AS question,
         CASE WHEN l.slug IS NOT NULL THEN l.is_resolved ELSE c.is_resolved END AS is_resolved,
         c.created_at, CASE WHEN l.slug IS NOT NULL THEN {_SQL_NOW} ELSE c.updated_at END AS updated_at
  FROM cur c LEFT JOIN last l ON l.slug = c.slug
  UNION ALL
  SELECT (SELECT max(id) FROM cur) + row_number() OVER (ORDER BY l.first_ord) AS id, '{C.DEFAULT_SOURCE_TAG}',
         l.slug, l.question, l.is_resolved, {_SQL_NOW}, {_SQL_NOW}
  FROM last l WHERE l.slug NOT IN (SELECT slug FROM cur))"""


@query("ingest_counters", with_ctes("fx_feed") + _SQL_STAGED + """
SELECT count(*) FILTER (WHERE status = 'ok') AS success_count,
       count(*) FILTER (WHERE status <> 'ok') AS error_count FROM staged""")
def q_ingest_counters(spark, sf):
    return C.ingest_counters(_staged(spark, sf))


def _upserted(spark, sf):
    return C.upsert_markets(X.fx_market_rows(spark, sf), _staged(spark, sf), FX_NOW, _ORDER)


@query("upsert_markets", with_ctes("fx_markets", "fx_feed") + _SQL_STAGED + " SELECT * FROM upserted")
def q_upsert_markets(spark, sf):
    return _upserted(spark, sf).select(*C.MARKET_COLUMNS)


@query("upsert_market_embeddings", with_ctes("fx_markets", "fx_feed") + _SQL_STAGED + """,
fresh AS (SELECT u.id AS market_id, l.question FROM last l JOIN upserted u ON u.slug = l.slug)"""
       + hash_sql("fq", "fresh", "market_id", "question") + f""",
fresh_sum AS (SELECT id AS market_id, sum(CAST(v AS DOUBLE)) AS l1, count(*) AS nb FROM fq_vec GROUP BY id)
SELECT coalesce(f.market_id, c.id) AS id, coalesce(f.market_id, c.id) AS market_id,
       CASE WHEN f.market_id IS NOT NULL THEN {FX_DIM} ELSE len(c.embedding) END AS dim,
       round(CASE WHEN f.market_id IS NOT NULL THEN s.l1 ELSE list_sum(c.embedding) END, 5) AS l1,
       CASE WHEN f.market_id IS NOT NULL THEN {_SQL_NOW} ELSE c.created_at END AS created_at
FROM fx_markets c FULL OUTER JOIN fresh f ON f.market_id = c.id
LEFT JOIN fresh_sum s ON s.market_id = f.market_id""")
def q_upsert_market_embeddings(spark, sf):
    staged = _staged(spark, sf)
    markets = C.upsert_markets(X.fx_market_rows(spark, sf), staged, FX_NOW, _ORDER)
    vecs = C.upsert_market_embeddings(X.fx_market_embeddings(spark, sf), markets, staged, FX_NOW, _ORDER)
    return vecs.select("id", "market_id", F.size("embedding").alias("dim"),
                       F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("l1"),
                       "created_at")


@query("upsert_idempotent", with_ctes("fx_markets", "fx_feed") + _SQL_STAGED + """
SELECT id, source, slug, question, is_resolved FROM upserted""")
def q_upsert_idempotent(spark, sf):
    staged = _staged(spark, sf)
    once = C.upsert_markets(X.fx_market_rows(spark, sf), staged, FX_NOW, _ORDER)
    twice = C.upsert_markets(once, staged, FX_NOW + _dt.timedelta(hours=1), _ORDER)
    return twice.select("id", "source", "slug", "question", "is_resolved")


# =========================================================================== serving

from semjoin.operators import serving as SV  # noqa: E402


def _iso_sql(c: str) -> str:
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN epoch_us({c}) % 1000000 = 0 "
            f"THEN strftime({c}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') END")


_SQL_MK_LIST = f"id, source, slug, question, is_resolved, {_iso_sql('created_at')} AS created_at, " \
               f"{_iso_sql('updated_at')} AS updated_at"


@query("markets_list", with_ctes("fx_markets") + f"""
SELECT {_SQL_MK_LIST} FROM fx_markets ORDER BY created_at DESC, id LIMIT 100""")
def q_markets_list(spark, sf):
    return SV.markets_list(X.fx_market_rows(spark, sf), 100)


@query("markets_by_resolved", with_ctes("fx_markets") + f"""
SELECT {_SQL_MK_LIST} FROM fx_markets WHERE is_resolved = true ORDER BY created_at DESC, id LIMIT 1000""")
def q_markets_by_resolved(spark, sf):
    return SV.markets_list(X.fx_market_rows(spark, sf), 1000, is_resolved=True)


@query("markets_iso", with_ctes("fx_markets") + f""",
m AS (SELECT id, CASE WHEN id % 2 = 0 THEN date_trunc('second', created_at) ELSE created_at END AS created_at,
             updated_at FROM fx_markets)
SELECT id, {_iso_sql('created_at')} AS created_at, {_iso_sql('updated_at')} AS updated_at FROM m""")
def q_markets_iso(spark, sf):
    m = X.fx_market_rows(spark, sf)
    m = m.withColumn("created_at", F.when(F.col("id") % 2 == 0, F.date_trunc("second", "created_at"))
                     .otherwise(F.col("created_at")).cast("timestamp_ntz"))
    return SV.markets_iso(m.select("id", "created_at", "updated_at"))


_SQL_BUF = """,
buf AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY arrival DESC) AS rn FROM fx_arrivals) WHERE rn <= 1000)"""


@query("recent_by_topic", with_ctes("fx_arrivals") + _SQL_BUF + " SELECT topic, arrival, time FROM buf")
def q_recent_by_topic(spark, sf):
    return SV.recent_by_topic(X.fx_arrivals(spark, sf)).select("topic", "arrival", "time")


@query("recent_news", with_ctes("fx_arrivals") + _SQL_BUF + """
SELECT arrival, time, source FROM buf WHERE topic = 'news_stream' ORDER BY arrival DESC LIMIT 100""")
def q_recent_news(spark, sf):
    return SV.recent(X.fx_arrivals(spark, sf), SV.NEWS_TOPIC, 100).select("arrival", "time", "source")


@query("news_by_source", with_ctes("fx_arrivals") + _SQL_BUF + """
SELECT arrival, source FROM buf WHERE topic = 'news_stream' AND lower(coalesce(source, '')) = lower('SRC3')""")
def q_news_by_source(spark, sf):
    return SV.news_by_source(X.fx_arrivals(spark, sf), "SRC3").select("arrival", "source")


@query("api_news", with_ctes("fx_arrivals") + _SQL_BUF + """
SELECT source, date, time, news FROM (
  SELECT * FROM buf WHERE topic = 'news_stream' ORDER BY arrival DESC LIMIT 100)
WHERE source IS NOT NULL AND date IS NOT NULL AND time IS NOT NULL AND news IS NOT NULL""")
def q_api_news(spark, sf):
    return SV.api_news(_under_two_names(SV.recent(X.fx_arrivals(spark, sf), SV.NEWS_TOPIC, 100)))


def _under_two_names(items):
    """Every third item carries its fields under the other accepted names (headline, published_date, published_time)."""
    other = F.col("arrival") % 3 == 0
    for field, name in (("news", "headline"), ("date", "published_date"), ("time", "published_time")):
        items = items.withColumn(name, F.when(other, F.col(field))).withColumn(field, F.when(~other, F.col(field)))
    return items


@query("api_processed", with_ctes("fx_arrivals") + _SQL_BUF + """
SELECT source, date, time, news, matched_market, matched_market_id, matched_market_question, match_score FROM (
  SELECT * FROM buf WHERE topic = 'processed_news' ORDER BY arrival DESC LIMIT 100)
WHERE source IS NOT NULL AND date IS NOT NULL AND time IS NOT NULL AND news IS NOT NULL""")
def q_api_processed(spark, sf):
    return SV.api_processed(_under_two_names(SV.recent(X.fx_arrivals(spark, sf), SV.PROCESSED_TOPIC, 100)))


def _stat_markets(spark, sf):
    m = X.fx_market_rows(spark, sf).withColumn(
        "is_resolved", F.when(F.col("id") % 7 == 0, F.lit(None).cast("boolean")).otherwise(F.col("is_resolved")))
    v = X.fx_market_embeddings(spark, sf).where(F.col("market_id") % 3 != 0)
    return m, v


_SQL_MSTATS = """,
ms AS (
  SELECT count(*) AS total_markets,
         count(*) FILTER (WHERE is_resolved = false) AS active_markets,
         count(*) FILTER (WHERE is_resolved = true) AS resolved_markets,
         count(DISTINCT me.market_id) AS markets_with_embeddings
  FROM (SELECT id, CASE WHEN id % 7 = 0 THEN NULL ELSE is_resolved END AS is_resolved FROM fx_markets) m
  LEFT JOIN (SELECT id AS market_id FROM fx_markets WHERE id % 3 <> 0) me ON m.id = me.market_id)"""

_SQL_BSTATS = """,
bs AS (
  SELECT least(count(*) FILTER (WHERE topic = 'news_stream'), 3000) AS total_news,
         least(count(*) FILTER (WHERE topic = 'processed_news'), 3000) AS total_processed,
         arg_max(time, arrival) FILTER (WHERE topic = 'news_stream') AS latest_news_time,
         arg_max(time, arrival) FILTER (WHERE topic = 'processed_news') AS latest_processed_time
  FROM fx_arrivals),
bs2 AS (SELECT total_news, total_processed,
               coalesce(round(100.0 * total_processed / nullif(total_news, 0), 2), 0.0) AS processing_rate,
               latest_news_time, latest_processed_time FROM bs)"""


@query("market_stats", with_ctes("fx_markets") + _SQL_MSTATS + " SELECT * FROM ms")
def q_market_stats(spark, sf):
    return SV.market_stats(*_stat_markets(spark, sf))


@query("buffer_stats", with_ctes("fx_arrivals") + _SQL_BSTATS + " SELECT * FROM bs2")
def q_buffer_stats(spark, sf):
    return SV.buffer_stats(X.fx_arrivals(spark, sf), cap=3000)


@query("pipeline_stats", with_ctes("fx_arrivals") + _SQL_BSTATS.replace("3000", str(SV.BUFFER_SIZE)) + " SELECT * FROM bs2")
def q_pipeline_stats(spark, sf):
    return SV.buffer_stats(X.fx_arrivals(spark, sf))


@query("combined_stats", with_ctes("fx_markets", "fx_arrivals") + _SQL_MSTATS + _SQL_BSTATS + """
SELECT bs2.*, ms.total_markets AS markets_total_markets, ms.active_markets AS markets_active_markets,
       ms.resolved_markets AS markets_resolved_markets, ms.markets_with_embeddings AS markets_markets_with_embeddings
FROM bs2, ms""")
def q_combined_stats(spark, sf):
    s = SV.combined_stats(X.fx_arrivals(spark, sf), *_stat_markets(spark, sf), cap=3000)
    return s.select("total_news", "total_processed", "processing_rate", "latest_news_time", "latest_processed_time",
                    *[F.col(f"markets.{c}").alias(f"markets_{c}") for c in
                      ("total_markets", "active_markets", "resolved_markets", "markets_with_embeddings")])


@query("table_audit", with_ctes("fx_markets", "fx_news") + """
SELECT 'news' AS table_name, count(*) AS n FROM fx_news
UNION ALL SELECT 'news_embeddings', count(*) FROM fx_news WHERE embedding IS NOT NULL
UNION ALL SELECT 'markets', count(*) FROM fx_markets
UNION ALL SELECT 'market_embeddings', count(*) FROM fx_markets WHERE embedding IS NOT NULL""")
def q_table_audit(spark, sf):
    news = X.fx_news(spark, sf)
    mk = X.fx_markets(spark, sf)
    return SV.table_audit({"news": news.drop("embedding"),
                           "news_embeddings": news.select("news_id", "embedding").where(F.col("embedding").isNotNull()),
                           "markets": mk.drop("embedding"),
                           "market_embeddings": X.fx_market_embeddings(spark, sf).where(F.col("embedding").isNotNull())})


@query("delta_feed", with_ctes("fx_arrivals") + """,
since AS (SELECT topic, CASE WHEN topic = 'news_stream' THEN max(arrival) - 100 ELSE max(arrival) END AS last_arrival
          FROM fx_arrivals GROUP BY topic)
SELECT topic, arrival, time FROM (
  SELECT a.*, row_number() OVER (PARTITION BY a.topic ORDER BY a.arrival DESC) AS rn
  FROM fx_arrivals a JOIN since s ON s.topic = a.topic WHERE a.arrival > s.last_arrival) WHERE rn <= 10""")
def q_delta_feed(spark, sf):
    arr = X.fx_arrivals(spark, sf)
    since = arr.groupBy("topic").agg(
        F.when(F.col("topic") == SV.NEWS_TOPIC, F.max("arrival") - 100).otherwise(F.max("arrival")).alias("last_arrival"))
    return SV.delta_feed(arr, since).select("topic", "arrival", "time")


# =========================================================================== store, integrity, publish, stream

from semjoin.operators import publish as PUB  # noqa: E402
from semjoin.operators import store as ST  # noqa: E402
from semjoin.sources import streams as SRC  # noqa: E402
from semjoin.streaming import news_job as JOB  # noqa: E402


def _hash_catalogue(spark, sf):
    """Open markets with their questions embedded by the same embedder as the news (the ingest path)."""
    m = M.active_markets(X.fx_market_rows(spark, sf))
    return m.select("id", "slug", "question", _embedder()(F.col("question")).alias("embedding"))


def _processed_raw(spark, sf):
    p = N.process(X.fx_raw(spark, sf), _embedder(), _hash_catalogue(spark, sf), dim=FX_DIM,
                  threshold=FX_THRESHOLD)
    return ST.with_news_id(p, key="msg_id")


_SQL_RAW_MATCH = _SQL_RAW_STATUS + """,
rcat AS (SELECT id, slug, question FROM fx_markets WHERE is_resolved = false)""" + \
    hash_sql("ch", "rcat", "id", "question") + hash_sql("nh", "raw_st", "msg_id", "headline") + f""",
dots AS (SELECT n.id AS msg_id, c.id AS market_id, sum(CAST(n.v AS DOUBLE) * CAST(c.v AS DOUBLE)) AS d
         FROM nh_vec n JOIN ch_vec c ON n.bucket = c.bucket GROUP BY 1, 2),
nn AS (SELECT id, sqrt(sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE))) AS nrm FROM nh_vec GROUP BY id),
cn AS (SELECT id, sqrt(sum(CAST(v AS DOUBLE) * CAST(v AS DOUBLE))) AS nrm FROM ch_vec GROUP BY id),
rsims AS (SELECT d.msg_id, d.market_id, d.d / (a.nrm * b.nrm) AS sim
          FROM dots d JOIN nn a ON a.id = d.msg_id JOIN cn b ON b.id = d.market_id),
rtop AS (SELECT msg_id, market_id, sim FROM (
           SELECT *, row_number() OVER (PARTITION BY msg_id ORDER BY round(sim, 12) DESC, market_id) AS rn
           FROM rsims) WHERE rn = 1 AND sim >= {FX_THRESHOLD}),
published AS (
  SELECT r.source, r.headline, c.slug AS matched_market, round(t.sim, 6) AS match_score, r.embedding_status,
         r.db_status, r.db_status = 'saved' AS has_news_id, CASE WHEN r.has_tags THEN 1 END AS tags_k
  FROM raw_db r JOIN rtop t ON t.msg_id = r.msg_id JOIN rcat c ON c.id = t.market_id)"""

_SQL_STORED = with_ctes("fx_raw") + _SQL_RAW_STATUS + """
SELECT source, CAST(published_date AS DATE) AS published_date, stored_time AS published_time, headline FROM raw_db
WHERE db_status = 'saved'"""

_SQL_STORED_VEC = with_ctes("fx_raw") + _SQL_RAW_STATUS + """,
saved AS (SELECT msg_id, headline FROM raw_db WHERE db_status = 'saved')""" + \
    hash_sql("sh", "saved", "msg_id", "headline") + f""",
sums AS (SELECT id, sum(CAST(v AS DOUBLE)) AS l1 FROM sh_vec GROUP BY id)
SELECT s.headline, {FX_DIM} AS dim, round(u.l1, 5) AS l1 FROM saved s JOIN sums u ON u.id = s.msg_id"""


def _read_stored(spark, root):
    news = spark.read.parquet(f"{root}/news")
    return news.select("source", "published_date", "published_time", "headline")


def _read_stored_vectors(spark, root):
    news = spark.read.parquet(f"{root}/news").select("id", "headline")
    vec = spark.read.parquet(f"{root}/news_embeddings").select("news_id", "embedding")
    j = vec.join(news, vec["news_id"] == news["id"])
    return j.select("headline", F.size("embedding").alias("dim"),
                    F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double")), 5).alias("l1"))


def _read_published(spark, path):
    from semjoin.functions.jsonio import parse_json_object
    p = spark.read.parquet(path).select(parse_json_object(F.col("value")).alias("m"))

    def s(k):
        return F.try_variant_get(F.col("m")[k], "$", "string")
    return p.select(s("source").alias("source"),
                    F.coalesce(F.nullif(s("headline"), F.lit("")), s("news")).alias("headline"),
                    s("matched_market").alias("matched_market"),
                    F.round(F.try_variant_get(F.col("m")["match_score"], "$", "double"), 6).alias("match_score"),
                    s("embedding_status").alias("embedding_status"), s("db_status").alias("db_status"),
                    F.col("m")["news_id"].isNotNull().alias("has_news_id"),
                    F.try_variant_get(F.col("m")["tags"], "$.k", "int").alias("tags_k"))


def _store_batch(spark, sf):
    root = shared_dir(spark, "store")
    ST.append_news(_processed_raw(spark, sf), root, 0, FX_NOW)
    return root


@query("store_news", _SQL_STORED)
def q_store_news(spark, sf):
    return _read_stored(spark, _store_batch(spark, sf))


@query("store_news_embeddings", _SQL_STORED_VEC)
def q_store_news_embeddings(spark, sf):
    return _read_stored_vectors(spark, _store_batch(spark, sf))


@query("publish_payload", with_ctes("fx_markets", "fx_raw") + _SQL_RAW_MATCH + " SELECT * FROM published")
def q_publish_payload(spark, sf):
    path = shared_dir(spark, "published")
    PUB.payloads(_processed_raw(spark, sf)).write.mode("overwrite").parquet(path)
    return _read_published(spark, path)


MESSAGES_PER_FILE = 500      # files, and with them tasks and batch sizes, grow with the data


def _run_stream(spark, sf):
    """Land the raw messages as files and run the streaming job over them in two micro-batches of half the files each."""
    base_dir = shared_dir(spark, "stream")
    inbox, out, ckpt = f"{base_dir}/inbox", f"{base_dir}/out", f"{base_dir}/checkpoint"
    raw = X.fx_raw(spark, sf)
    SRC.write_message_files(raw.select("value"), inbox, per_file=MESSAGES_PER_FILE)
    # the catalogue as stored by the ingest (markets joined with their vectors), re-read by every batch
    cat_path = f"{base_dir}/catalogue"
    _hash_catalogue(spark, sf).write.parquet(cat_path)
    files = spark.read.format("binaryFile").load(inbox).select("path").count()     # names only
    stream = SRC.read_message_files(spark, inbox, stream=True, max_files_per_trigger=max(1, -(-files // 2)))
    # written once, so its version never changes: measured and broadcast once for all batches
    q = JOB.start(stream, out, ckpt, embedder=_embedder(), load_catalogue=lambda: spark.read.parquet(cat_path),
                  catalogue_version=lambda: cat_path, dim=FX_DIM, threshold=FX_THRESHOLD, now=lambda: FX_NOW)
    try:
        q.awaitTermination()
    finally:
        q.release_catalogue()
    return out


@query("stream_bad_records", with_ctes("fx_raw") + """
SELECT CASE WHEN k = 0 THEN concat('{"news": ', replace(replace(body, chr(10), ' '), chr(13), ' '))
            ELSE CAST(to_json([body]) AS VARCHAR) END AS value FROM fx_raw WHERE bad""")
def q_stream_bad_records(spark, sf):
    return spark.read.parquet(f"{_run_stream(spark, sf)}/bad_records").select("value")


@query("stream_status_counts", with_ctes("fx_raw") + _SQL_RAW_STATUS + """
SELECT embedding_status, db_status, CAST(count(*) AS BIGINT) AS n FROM raw_db GROUP BY 1, 2""")
def q_stream_status_counts(spark, sf):
    counts = spark.read.parquet(f"{_run_stream(spark, sf)}/status_counts")
    return counts.groupBy("embedding_status", "db_status").agg(F.sum("n").alias("n"))


@query("stream_ingest", _SQL_STORED)
def q_stream_ingest(spark, sf):
    return _read_stored(spark, _run_stream(spark, sf))


@query("stream_match", with_ctes("fx_markets", "fx_raw") + _SQL_RAW_MATCH + " SELECT * FROM published")
def q_stream_match(spark, sf):
    return _read_published(spark, f"{_run_stream(spark, sf)}/published")


def _deleted_markets(spark, sf):
    return X.fx_market_rows(spark, sf).where(F.col("id") % 3 != 0)


@query("orphan_embeddings", with_ctes("fx_markets") + """
SELECT id AS market_id FROM fx_markets WHERE id % 3 = 0""")
def q_orphan_embeddings(spark, sf):
    return ST.orphans(X.fx_market_embeddings(spark, sf), _deleted_markets(spark, sf), "market_id").select("market_id")


@query("cascade_delete", with_ctes("fx_markets") + """
SELECT id AS market_id, len(embedding) AS dim FROM fx_markets WHERE id % 3 <> 0""")
def q_cascade_delete(spark, sf):
    kept = ST.cascade(X.fx_market_embeddings(spark, sf), _deleted_markets(spark, sf), "market_id")
    return kept.select("market_id", F.size("embedding").alias("dim"))


# =========================================================================== streaming catalogue refresh and delta push

from semjoin.streaming import delta as DELTA  # noqa: E402
from semjoin.streaming import ingest_job as INGEST  # noqa: E402


@query("ingest_stream", with_ctes("fx_markets", "fx_feed") + _SQL_STAGED + " SELECT * FROM upserted")
def q_ingest_stream(spark, sf):
    """Feed snapshots landed as files, applied by the streaming refresh job onto the stored tables."""
    root = shared_dir(spark, "catalogue")
    INGEST.create(X.fx_market_rows(spark, sf), X.fx_market_embeddings(spark, sf).withColumn("id", F.col("market_id")), root)
    inbox = f"{root}/inbox"
    FEED.write_feed(X.fx_feed_docs(spark, sf), inbox)
    q = INGEST.start(FEED.stream_feed(spark, inbox), root, f"{root}/checkpoint", embedder=_embedder(), limit=X.FEED_SNAPSHOT_ROWS,
                     now=lambda: FX_NOW)
    q.awaitTermination()
    return INGEST.read_markets(spark, root).select(*C.MARKET_COLUMNS)


TICKS = 3


def _deliver(spark, sf, root, start):
    """Land the arrivals tick by tick, as many files as the data makes, and run the query over each tick as it is there."""
    arr = X.fx_arrivals(spark, sf).withColumn("tick", (F.col("arrival") % TICKS).cast("long"))
    landed = f"{root}/inbox"
    schema = "topic string, arrival long, time string, tick long"
    for tick in range(TICKS):
        now = arr.where(F.col("tick") == tick).select("topic", "arrival", "time", "tick")
        now.write.mode("append").option("maxRecordsPerFile", 10_000).json(landed)
        start(spark.readStream.schema(schema).json(landed)).awaitTermination()


_SQL_TICKS = f"""
SELECT tick, topic, arrival FROM (
  SELECT arrival % {TICKS} AS tick, topic, arrival,
         row_number() OVER (PARTITION BY arrival % {TICKS}, topic ORDER BY arrival DESC) AS rn
  FROM fx_arrivals) WHERE rn <= 10"""


@query("delta_stream", with_ctes("fx_arrivals") + _SQL_TICKS)
def q_delta_stream(spark, sf):
    """Every tick pushes its newest 10 items per topic."""
    root = shared_dir(spark, "delta")

    def sink(items, batch_id):
        ST.write_batch(items, f"{root}/items", batch_id)
    _deliver(spark, sf, root, lambda stream: DELTA.start_items(stream, sink, f"{root}/checkpoint", available_now=True))
    return spark.read.parquet(f"{root}/items").select("tick", "topic", "arrival")


@query("delta_stats", with_ctes("fx_arrivals") + f""",
ticks AS (SELECT unnest(range({TICKS})) AS t),
s AS (SELECT t, least(count(*) FILTER (WHERE topic = 'news_stream'), 1000) AS total_news,
             least(count(*) FILTER (WHERE topic = 'processed_news'), 1000) AS total_processed,
             arg_max(time, arrival) FILTER (WHERE topic = 'news_stream') AS latest_news_time,
             arg_max(time, arrival) FILTER (WHERE topic = 'processed_news') AS latest_processed_time
      FROM ticks JOIN fx_arrivals ON arrival % {TICKS} <= t GROUP BY t)
SELECT CAST(t AS INTEGER) AS batch_id, total_news, total_processed,
       coalesce(round(100.0 * total_processed / nullif(total_news, 0), 2), 0.0) AS processing_rate,
       latest_news_time, latest_processed_time FROM s""")
def q_delta_stats(spark, sf):
    """The buffers' statistics as each tick pushed them."""
    root = shared_dir(spark, "delta-stats")

    def sink(stats, batch_id):
        ST.write_batch(stats, f"{root}/stats", batch_id)
    _deliver(spark, sf, root, lambda stream: DELTA.start_stats(stream, sink, f"{root}/checkpoint", available_now=True))
    return spark.read.parquet(f"{root}/stats")


from semjoin.streaming import buffer_job as BUF  # noqa: E402


@query("buffer_stream", with_ctes("fx_arrivals") + _SQL_BUF + " SELECT topic, arrival, time FROM buf")
def q_buffer_stream(spark, sf):
    """Both topics landed as files tick by tick and read as one stream, restarted every tick, into the bounded buffers."""
    root = shared_dir(spark, "buffers")
    _deliver(spark, sf, root, lambda stream: BUF.start(stream.drop("tick"), f"{root}/checkpoint"))
    return BUF.read(spark, f"{root}/checkpoint", DELTA.BUFFER_SCHEMA)


# =========================================================================== topics kept as files

from semjoin.sources import file_topics as FT  # noqa: E402


def _halves(spark, sf):
    arr = X.fx_arrivals(spark, sf).select("topic", "arrival", "time")
    return arr.where(F.col("arrival") % 2 == 0), arr.where(F.col("arrival") % 2 == 1)


@query("topic_latest", with_ctes("fx_arrivals") + " SELECT topic, arrival, time FROM fx_arrivals WHERE arrival % 2 = 1")
def q_topic_latest(spark, sf):
    """Half of the items published, a stream started at the topic's end, the other half published: what the stream got."""
    root = shared_dir(spark, "topic")
    publish, (first, second) = FT.publish_to_file_topic(f"{root}/topic"), _halves(spark, sf)

    def tail():
        stream = FT.read_file_topic_stream(spark, f"{root}/topic", DELTA.BUFFER_SCHEMA, starting="latest")
        w = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        w.trigger(availableNow=True).start().awaitTermination()
    publish(first, 0)
    tail()
    publish(second, 1)
    tail()
    return spark.read.schema(DELTA.BUFFER_SCHEMA).parquet(f"{root}/out")


@query("publish_once", with_ctes("fx_arrivals") + " SELECT topic, arrival, time FROM fx_arrivals")
def q_publish_once(spark, sf):
    """Two batches published, each run again as after a lost job: the topic holds every item once."""
    path = shared_dir(spark, "topic-once")
    publish = FT.publish_to_file_topic(path)
    for offset, half in enumerate(_halves(spark, sf)):
        publish(half, offset)
        publish(half, offset)
    return FT.read_file_topic(spark, path, DELTA.BUFFER_SCHEMA)
