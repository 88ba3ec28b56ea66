"""The corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing to target weights, packing.

Every stage works on all rows the one before kept. ``run`` writes each stage's result as Parquet in the shared folder
and reads it back, which cuts lineage: a lost executor costs tasks of the running stage only. Mixing drops nothing; it
orders the files and rows it returns by schedule slot, and packing fills its batches in that order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semjoin.llm import exact_dedup, mixing, packing, simhash, toxicity
from semjoin.llm.common import stage
from semjoin.llm.queries import NEAR_BITS, NEAR_WORDS, PACK, toxicity_model


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 stay."""
    return toxicity.keep_clean(docs, toxicity_model(spark, docs, sf_dir))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.DigestIndex(spark).keep_new(docs, batch=1)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the row with the smallest doc_id stays."""
    return simhash.keep_one_of_each(docs, NEAR_WORDS, NEAR_BITS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in schedule order; weights are the square roots of the sources' characters."""
    chars = F.length("text")
    return mixing.in_mix_order(docs, chars, mixing.source_weights(docs, chars))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's bucket, batch and position; batches fill in the order of the mixing stage's files."""
    return packing.pack(docs, packing.word_count(F.col("text")), **PACK, keep_file_order=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: A fitted model and fingerprints' components are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
