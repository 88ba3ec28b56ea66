"""Dense row numbering without a global window.

``row_number()`` over an unpartitioned window pulls every row into one task.
Instead (as ``zipWithIndex`` does): count rows per input partition (a tiny
aggregate, one row per partition), turn the counts into start offsets, and add
each row's position inside its partition. The offsets table has one row per
partition, so broadcasting it is bounded by the partition count, not the data.

The input is evaluated twice (counts, then rows), so both passes must see
the same partitions. A file scan or a persisted frame does; a frame whose
plan contains a shuffle may not (adaptive execution can coalesce the two
shuffles differently), so such input is first checkpointed to the shared
checkpoint folder - reliably, which also cuts its lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33


def _has_shuffle(df: DataFrame) -> bool:
    from semjoin.operators.partitioning import has_shuffle
    return has_shuffle(df)


def with_dense_index(df: DataFrame, col: str = "row_index", start: int = 0,
                     materialize: bool | None = None) -> DataFrame:
    """``df`` plus ``col``: start, start+1, ... in partition order (key order after ``orderBy``)."""
    if materialize is None:
        materialize = _has_shuffle(df)
    if materialize:
        from semjoin.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    tagged = df.withColumn("_mid", mid)
    tagged = (tagged.withColumn("_part", F.shiftright("_mid", _POS_BITS))
                    .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1))))
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a single-task window here is bounded by the partition count
    offsets = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_part")
    return out.withColumn(col, F.col("_off") + F.col("_pos") + F.lit(start)).drop("_mid", "_part", "_pos", "_off")
