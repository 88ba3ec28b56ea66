"""Spreading under-partitioned input before CPU-heavy per-row work.

Parsing whole JSON texts and embedding whole documents cost CPU per row. A
scan of one large row group is a single task no matter how many cores wait,
so input that is cut into few, large splits is redistributed first. Input
that already feeds a fair share of the cores, has small splits, or is large
as a whole is left alone: no shuffle is added where it gains little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Ours: bytes of a split from which spreading it pays, and of an input from which it is never spread.
SPREAD_SPLIT_BYTES = 1 << 20
SPREAD_MOST_BYTES = 64 << 30
# Ours: spread only when at least this many times as many tasks would run.
SPREAD_GAIN = 2


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``df`` over as many tasks as there are cores, where that pays (see above)."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = max(1, partition_count(df))
    if n * SPREAD_GAIN > target or not n * SPREAD_SPLIT_BYTES <= _input_bytes(df) <= SPREAD_MOST_BYTES:
        return df
    return df.repartition(target)


def _input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` reads (a plan's own estimate multiplies the sides of a join)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def partition_count(df: DataFrame) -> int:
    """Output partitions of ``df``, read from its physical plan without running anything.

    ``df.rdd.getNumPartitions()`` builds the adaptive plan's final form, which
    runs every shuffle and broadcast stage below it - a second computation of
    the input. Here: a shuffle's partition count, a scan's split count, the
    largest input of a join (a broadcast side counts nothing), the sum of a
    union; adaptive execution may later coalesce below the shuffle count.
    Unrecognised leaves fall back to ``getNumPartitions``.
    """
    try:
        return _partitions(df._jdf.queryExecution().executedPlan())
    except Exception:  # noqa: BLE001 - unknown plan shape
        return df.rdd.getNumPartitions()


def _partitions(node) -> int:
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return _partitions(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return _partitions(node.plan())
    if name == "ReusedExchangeExec":
        return _partitions(node.child())
    if name == "ShuffleExchangeExec" or name == "CoalesceExec":
        return int(node.outputPartitioning().numPartitions())
    if name == "BroadcastExchangeExec":
        return 0
    if name in ("FileSourceScanExec", "BatchScanExec"):
        return int(node.inputRDD().getNumPartitions())
    if name == "RDDScanExec":                      # e.g. a checkpointed frame read back
        return int(node.rdd().getNumPartitions())
    if name == "LocalTableScanExec":               # rows held by the driver: building the RDD runs nothing
        return int(node.execute().getNumPartitions())
    if name == "RangeExec":
        return int(node.numSlices())
    if name == "InMemoryTableScanExec":
        return _partitions(node.relation().cachedPlan())
    kids = node.children()
    n = kids.size()
    if n == 0:
        raise ValueError(f"unknown leaf {name}")
    counts = [_partitions(kids.apply(i)) for i in range(n)]
    return sum(counts) if name == "UnionExec" else max(counts)


def materialize_python(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder when its plan runs a Python step.

    Used before work that reads its input more than once - a range sort samples
    its input before shuffling it; the blocked matcher reads its left side for
    the list sizes, the co-group and the join back - so an embedding (or list
    probing) runs once per row instead of once per pass.
    """
    if not has_python_step(df):
        return df
    from semjoin.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Physical operators that run Python (UDFs, pandas/Arrow maps and co-groups, pandas aggregates/windows).
_PYTHON_NODE_MARKS = ("Python", "Pandas", "InArrow")


def has_python_step(df: DataFrame) -> bool:
    """Whether computing ``df`` runs a Python step that is not already cached.

    Walks the physical plan; an in-memory scan of persisted data is a leaf, so
    a Python step below a cache (already computed once) does not count.
    """
    return _plan_has(df, _PYTHON_NODE_MARKS, "EvalPython")


def has_shuffle(df: DataFrame) -> bool:
    """Whether computing ``df`` runs a shuffle that is not already cached."""
    return _plan_has(df, ("ShuffleExchange",), "Exchange")


def _plan_has(df: DataFrame, marks: tuple[str, ...], text_mark: str) -> bool:
    try:
        stack = [df._jdf.queryExecution().executedPlan()]
        while stack:
            node = stack.pop()
            name = node.getClass().getSimpleName()
            if any(m in name for m in marks):
                return True
            if name == "AdaptiveSparkPlanExec":
                stack.append(node.executedPlan())
            elif name.endswith("QueryStageExec"):
                stack.append(node.plan())
            elif name == "ReusedExchangeExec":
                stack.append(node.child())
            kids = node.children()
            stack.extend(kids.apply(i) for i in range(kids.size()))
        return False
    except Exception:  # noqa: BLE001 - plan shapes differ across versions: fall back to the plan text
        return text_mark in df._jdf.queryExecution().executedPlan().toString()
