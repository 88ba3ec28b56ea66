"""Newest ``n`` rows per key, in rounds whose tasks each rank a bounded number of rows.

``row_number() <= n`` is planned by Spark as a partial ``WindowGroupLimit``
in every map task (``n`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``),
so each map task forwards at most ``n`` rows per key. The final task of a hot
key still receives ``input partitions x n`` rows, which grows with the data:
800k partitions of a 100 TB log give 800M rows to one task.

Here, while ``runs x n`` (runs = map partitions, at first) exceeds
``max_task_rows``, a grouping round ranks per ``(key, group of runs)``: each
group's reducer receives at most ``max_task_rows`` rows (or two runs, if those
are more) and keeps ``n``, leaving one run per group for the next round. One
round covers up to ``(max_task_rows / n)^2`` input partitions.

Beyond the threshold Spark limits nothing map-side, so a first round ranks per
``(key, input partition)``: a shuffle of all rows, but no task sees more of a
key than one input partition holds. Every step is a window in the JVM, so
values come out as they went in.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from semjoin.operators.partitioning import partition_count

# Ours: most rows one task ranks for one key in a round.
MAX_TASK_ROWS = 2_000_000


def _group_limit_threshold(df: DataFrame) -> int:
    return int(str(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")))


def _rank_within(df: DataFrame, keys: list[str], order_col: str, n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(order_col))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def top_n_per_key(df: DataFrame, key: str, order_col: str, n: int,
                  max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
    """Rows of ``df`` among the ``n`` largest ``order_col`` of their ``key`` (``order_col`` unique per key)."""
    if n < 1:
        raise ValueError(f"n must be >= 1, got {n!r}")
    runs = partition_count(df)         # from the plan: nothing runs before the real query
    budget = max(max_task_rows, 2 * n)                       # two runs at least, or no round would get anywhere
    limited = n <= _group_limit_threshold(df)
    if runs * n <= budget and limited or runs == 1:
        return _rank_within(df, [key], order_col, n)
    grouped = df.withColumn("_g", F.spark_partition_id())
    if not limited:
        grouped = _rank_within(grouped, [key, "_g"], order_col, n)
    while runs * n > budget:
        runs = math.ceil(runs * n / budget)
        grouped = _rank_within(grouped.withColumn("_g", F.pmod("_g", F.lit(runs))), [key, "_g"], order_col, n)
    return _rank_within(grouped.drop("_g"), [key], order_col, n)
