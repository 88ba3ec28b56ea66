"""Publishing matched records: every input key except the vector, plus the processing results, as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semjoin.functions.jsonio import to_json_text

RESULT_KEYS = ("embedding_dim", "embedding_status", "matched_market", "matched_market_id",
               "matched_market_question", "match_score", "news_id", "db_status")


def matched_only(df: DataFrame) -> DataFrame:
    """Records with a match, whatever their store status."""
    return df.where(F.col("matched_market").isNotNull())


def payload(df: DataFrame) -> Column:
    """``record`` (input keys, vector and reserved keys already removed) merged with the result fields.

    ``news_id`` is present only for stored records, as in the processing step.
    """
    keys = [k for k in RESULT_KEYS if k in df.columns]
    res = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                            F.array(*[F.col(k).cast("variant") for k in keys]))
    res = F.map_filter(res, lambda k, v: (k != "news_id") | v.isNotNull())
    return to_json_text(F.map_concat(F.col("record"), res))


def payloads(processed: DataFrame) -> DataFrame:
    """One ``value`` string per matched record: what goes to the output topic."""
    return matched_only(processed).select(payload(processed).alias("value"))
