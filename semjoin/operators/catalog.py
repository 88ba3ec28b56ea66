"""Market catalogue: read a feed snapshot, normalise it, and upsert markets and their vectors.

Upserts are keyed set operations, not row loops: the rows of one run collapse
to the last row per key (``max_by`` on feed order, partially aggregated before
the shuffle), then one full outer join on the key merges them with the current
table. New keys get ids after the current maximum, in order of first
appearance, numbered without a global window (``semjoin.operators.ids``).
"""

from __future__ import annotations

import datetime as _dt
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semjoin.functions.jsonio import truthy_text, variant_bool
from semjoin.operators.ids import with_dense_index
from semjoin.operators.partitioning import materialize_python

# Fixed value: rows taken from one feed fetch.
DEFAULT_FEED_LIMIT = 20
# Ours: bytes of a feed document from which it is cut into its elements before it is parsed.
BIG_DOCUMENT = 16 * 1024 * 1024
# Ours: the tag written into ``source`` for rows this ingest creates.
DEFAULT_SOURCE_TAG = "feed"

MARKET_COLUMNS = ["id", "source", "slug", "question", "is_resolved", "created_at", "updated_at"]
VECTOR_COLUMNS = ["id", "market_id", "embedding", "created_at"]

ST_OK, ST_INVALID, ST_NO_EMBEDDING = "ok", "invalid", "no_embedding"


# --------------------------------------------------------------------------- feed

def feed_rows(docs: DataFrame, limit: int = DEFAULT_FEED_LIMIT, value_col: str = "value") -> DataFrame:
    """One row per market of each feed document, first ``limit`` by position.

    A document is a JSON array of markets, or an object holding the array under
    ``data`` (checked first) or ``markets``; anything else yields no rows. Adds
    ``pos`` (position in its document) and ``market`` (``map<string,variant>``;
    NULL when the element is not an object, which the ingest counts as an error).
    Documents of any size are read; ``unreadable_documents`` gives those that are no feed documents.
    """
    arr = _feed_array(F.col(value_col))
    # cut the array before exploding it: a huge document never yields more than ``limit`` rows
    first = F.slice(F.coalesce(arr, F.array().cast("array<variant>")), 1, max(int(limit), 0))
    rows = docs.select("*", F.posexplode(first).alias("pos", "_m"))
    return rows.withColumn("market", F.try_variant_get(F.col("_m"), "$", "map<string,variant>")).drop("_m", value_col)


def unreadable_documents(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """The documents that ``feed_rows`` takes no rows from because they are not JSON, are cut off, or hold no array of markets."""
    return docs.where(_feed_array(F.col(value_col)).isNull())


def _feed_array(value: Column) -> Column:
    """The markets of a feed document as array<variant>; NULL when it is none.

    A variant holds some 100 MB at most, so a document over BIG_DOCUMENT bytes is cut into the texts of its elements
    first (``_cut_udf``), and each of these is parsed by itself.
    """
    big = F.octet_length(value) > F.lit(BIG_DOCUMENT)
    v = F.try_parse_json(F.when(~big, value))
    kind = F.schema_of_variant(v)
    obj = F.try_variant_get(v, "$", "map<string,variant>")
    whole = (F.when(kind.startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))
             .when(kind.startswith("OBJECT"),
                   F.when(F.map_contains_key(obj, "data"), F.try_variant_get(v, "$.data", "array<variant>"))
                    .otherwise(F.try_variant_get(v, "$.markets", "array<variant>"))))
    cut = F.transform(_cut_udf()(F.when(big, value)), lambda x: F.try_parse_json(x))
    return F.when(big, cut).otherwise(whole)


# Strings (skipped whole) and the marks that give a JSON text its structure.
_JSON_MARKS = re.compile(r'"[^"\\]*(?:\\.[^"\\]*)*"|[\[\]{},:]', re.S)
_CLOSED_BY = {"[": "]", "{": "}"}


def _parts(text: str, begin: int = 0) -> tuple[list[tuple[int, int, int]], int] | None:
    """The parts of the container that opens at ``begin``: (start, end, place of the first colon or -1), and where it ends.

    A part is an element of an array or a member of an object. None when brackets do not match.
    """
    open_, out, start, colon = [], [], begin + 1, -1
    for mark in _JSON_MARKS.finditer(text, begin):
        c = mark.group()
        if c in _CLOSED_BY:
            open_.append(_CLOSED_BY[c])
        elif c in ("]", "}"):
            if not open_ or open_.pop() != c:
                return None
            if not open_:
                if text[start:mark.start()].strip() or out:
                    out.append((start, mark.start(), colon))
                return out, mark.end()
        elif len(open_) == 1 and c == ",":
            out.append((start, mark.start(), colon))
            start, colon = mark.end(), -1
        elif len(open_) == 1 and c == ":" and colon < 0:
            colon = mark.start()
    return None


def feed_elements(text: str) -> list[str] | None:
    """The texts of a feed document's markets: of its array, or of that under ``data`` (first) or ``markets``; else None."""
    begin = len(text) - len(text.lstrip())
    if text[begin:begin + 1] not in _CLOSED_BY:
        return None
    found = _parts(text, begin)
    if found is None or text[found[1]:].strip():
        return None
    parts = found[0]
    if text[begin] == "{":
        members = {}
        for start, end, colon in parts:
            key = text[start:colon].strip() if colon >= 0 else ""
            if key in ('"data"', '"markets"'):
                members.setdefault(key, colon + 1 + len(text[colon + 1:end]) - len(text[colon + 1:end].lstrip()))
        at = members.get('"data"', members.get('"markets"'))
        if at is None or text[at:at + 1] != "[":
            return None
        parts = _parts(text, at)[0]
    return [text[start:end] for start, end, _ in parts]


def _cut_udf():
    @F.arrow_udf("array<string>")
    def cut(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else feed_elements(v) for v in values.to_pylist()], pa.list_(pa.string()))
    return cut


def normalize_feed(rows: DataFrame, source_tag: str = DEFAULT_SOURCE_TAG) -> DataFrame:
    """Adds ``slug`` (truthy ``market_slug`` else ``slug``), ``question``, ``is_resolved``, ``source``.

    ``is_resolved`` follows ``closed or resolved or is_resolved``: a truthy flag
    wins; otherwise the last flag decides, missing -> false, JSON null -> NULL.
    """
    m = F.col("market")
    last = m["is_resolved"]
    resolved = (F.when(variant_bool(m["closed"]) == F.lit(True), F.lit(True))
                .when(variant_bool(m["resolved"]) == F.lit(True), F.lit(True))
                .when(last.isNull(), F.lit(False))
                .otherwise(variant_bool(last)))
    return (rows.withColumn("slug", F.coalesce(truthy_text(m["market_slug"]), truthy_text(m["slug"])))
                .withColumn("question", truthy_text(m["question"]))
                .withColumn("is_resolved", F.when(m.isNotNull(), resolved))
                .withColumn("source", F.lit(source_tag)))


def feed_valid() -> Column:
    """A row can be ingested only with a truthy slug and question."""
    return F.col("slug").isNotNull() & F.col("question").isNotNull()


def ingest_status(rows: DataFrame, embedder) -> DataFrame:
    """Adds ``embedding`` (from the question) and ``status``; embedding comes before any write."""
    out = rows.withColumn("embedding", F.when(feed_valid(), embedder(F.col("question"))))
    st = (F.when(~feed_valid(), F.lit(ST_INVALID))
          .when(F.col("embedding").isNull(), F.lit(ST_NO_EMBEDDING))
          .otherwise(F.lit(ST_OK)))
    return out.withColumn("status", st)


def ingest_counters(staged: DataFrame) -> DataFrame:
    """Per run: rows upserted and rows that failed (invalid, unembeddable)."""
    return staged.agg(F.count_if(F.col("status") == ST_OK).alias("success_count"),
                      F.count_if(F.col("status") != ST_OK).alias("error_count"))


# --------------------------------------------------------------------------- upserts

def _last_per_key(rows: DataFrame, key: str, order: list[str], cols: list[str]) -> DataFrame:
    """Last row per key in ``order`` plus the key's first position; partial aggregation before the shuffle."""
    ordk = F.struct(*[F.col(c) for c in order])
    return (rows.groupBy(key)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols]), ordk).alias("_last"),
                 F.min(ordk).alias("_first"))
            .select(key, "_last.*", "_first"))


def highest_id(markets: DataFrame) -> int:
    """The highest id given out, 0 in an empty table."""
    return int(markets.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"])


def upsert_markets(current: DataFrame, staged: DataFrame, now, order: list[str] | None = None,
                   last_id: int | None = None) -> DataFrame:
    """New ``markets`` table state after applying the ``ok`` rows of a run, keyed on ``slug``.

    ``current`` may be a part of the table that holds every slug of the run;
    ``last_id`` is then the highest id given out so far.

    Existing slug: question, is_resolved and updated_at are replaced; id,
    source and created_at are kept. New slug: next id, created_at = updated_at = now.
    Within a run the last row of a slug wins.
    """
    order = order or ["pos"]
    now_c = F.lit(now).cast("timestamp_ntz")
    ok = staged.where(F.col("status") == ST_OK)
    # one row per slug; materialised when the feed was embedded on the way in, so the passes
    # below (join, the new-key sort's sampling, numbering) do not embed it again
    last = materialize_python(_last_per_key(ok, "slug", order, ["question", "is_resolved", "source"]))
    cur = current.select(*MARKET_COLUMNS)
    j = cur.alias("c").join(last.alias("n"), F.col("c.slug") == F.col("n.slug"), "full_outer")
    kept = j.where(F.col("c.id").isNotNull()).select(
        F.col("c.id").alias("id"), F.col("c.source").alias("source"), F.col("c.slug").alias("slug"),
        F.coalesce(F.col("n.question"), F.col("c.question")).alias("question"),
        F.when(F.col("n.slug").isNotNull(), F.col("n.is_resolved")).otherwise(F.col("c.is_resolved"))
         .alias("is_resolved"),
        F.col("c.created_at").alias("created_at"),
        F.when(F.col("n.slug").isNotNull(), now_c).otherwise(F.col("c.updated_at")).alias("updated_at"))
    new = j.where(F.col("c.id").isNull()).select(
        F.col("n.slug").alias("slug"), F.col("n.question").alias("question"),
        F.col("n.is_resolved").alias("is_resolved"), F.col("n.source").alias("source"), F.col("n._first").alias("_first"))
    if last_id is None:
        last_id = highest_id(current)
    numbered = with_dense_index(new.orderBy("_first"), "_idx", start=last_id + 1)
    inserted = numbered.select(F.col("_idx").cast("long").alias("id"), "source", "slug", "question", "is_resolved",
                               now_c.alias("created_at"), now_c.alias("updated_at"))
    return kept.unionByName(inserted)


def upsert_market_embeddings(current_vectors: DataFrame, markets: DataFrame, staged: DataFrame, now,
                             order: list[str] | None = None) -> DataFrame:
    """New ``market_embeddings`` state: keyed on ``market_id``; a replaced vector resets ``created_at``."""
    order = order or ["pos"]
    now_c = F.lit(now).cast("timestamp_ntz")
    ok = staged.where(F.col("status") == ST_OK)
    last = _last_per_key(ok, "slug", order, ["embedding"])
    ids = markets.select(F.col("id").alias("market_id"), "slug")
    fresh = last.join(ids, "slug").select("market_id", F.col("embedding").alias("n_embedding"))
    cur = current_vectors.select("market_id", "embedding", "created_at")
    j = cur.join(fresh, "market_id", "full_outer")
    return j.select(F.col("market_id").alias("id"), "market_id",
                    F.coalesce("n_embedding", "embedding").alias("embedding"),
                    F.when(F.col("n_embedding").isNotNull(), now_c).otherwise(F.col("created_at")).alias("created_at"))
