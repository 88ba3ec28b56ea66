"""Mixing sources to target weights by Pfair scheduling (DataFrame and SQL functions only).

Each source is a lane; its documents, in a pseudo-random but fixed order, are cut into blocks of ``block_size`` (the
block a document starts in). The schedule gives one block a slot. With w the lane's exact share of the weights, block j
is released at floor(j / w) and due at ceil((j + 1) / w), and each slot goes to the released block with the earliest
deadline. So after any t slots of the whole run every lane that has not run out has had w * t blocks with a deviation
below one block. The driver deals the slots out, with a size and a weight a lane and one block a lane in hand, and
writes them as Parquet in parts; they are joined with the documents by lane and block.

Weights come as a table (``source_weights``), in which every source has a lane of its own and its name stays in the
table, or as a dict, in which sources without a weight share one further lane (weight ``rest``).

Given a dict and ``slots``, weights are rounded to n_lane / slots and one frame of so many slots is repeated: the deviation is then
below one block from the rounded weights only, and grows with the run from the given ones.

Nothing is dropped or repeated: when a lane runs out the others keep to their releases and deadlines, and a slot for
which no block is released stays empty. A lane of any size is numbered in pieces (``common.running_sum``).

Defined cases: a null source is a source of its own; null and empty documents have size 0 and take the slot of the block they fall in; repeated rows stay; an empty table
gives an empty result; extra columns are kept, whatever their names.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from fractions import Fraction
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semjoin.llm.common import row_hash, running_sum, stage, whole_row
from semjoin.session import shared_dir

#: Rows of a lane that one piece of the running sum holds, about.
PIECE_ROWS = 4_000
#: Blocks of the schedule that the driver writes at a time, and up to which it is broadcast.
BLOCKS_AT_ONCE, BROADCAST_BLOCKS = 200_000, 1_000_000


def frame_counts(weights: list[float], slots: int) -> list[int]:
    """Slots of a frame for each weight: in proportion, one at least, the largest remainders rounded up."""
    if not weights or len(weights) > slots or min(weights) <= 0:
        raise ValueError("weights must be positive, and no more than slots")
    total = sum(map(Fraction, weights))
    spare = slots - len(weights)
    shares = [Fraction(w) / total * slots for w in weights]
    counts = [max(1, math.floor(s)) for s in shares]
    while sum(counts) > slots:                       # the ones raised to 1 are paid for by the most over-served
        counts[max((i for i in range(len(counts)) if counts[i] > 1), key=lambda i: counts[i] - shares[i])] -= 1
    for i in sorted(range(len(counts)), key=lambda i: counts[i] - shares[i])[:min(slots - sum(counts), spare)]:
        counts[i] += 1
    return counts


def frame_schedule(counts: list[int]) -> list[tuple[int, int, int]]:
    """(lane, block, place) of one frame of sum(counts) slots: earliest deadline first among the released blocks."""
    slots, ready, out = sum(counts), [], []
    release = [(0, lane, 0) for lane in range(len(counts))]
    heapq.heapify(release)
    for t in range(slots):
        while release and release[0][0] <= t:
            _, lane, j = heapq.heappop(release)
            heapq.heappush(ready, (-(-(j + 1) * slots // counts[lane]), lane, j))
        _, lane, j = heapq.heappop(ready)
        out.append((lane, j, t))
        if j + 1 < counts[lane]:
            heapq.heappush(release, ((j + 1) * slots // counts[lane], lane, j + 1))
    return out


def run_schedule(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """(lane, block, slot) of every block of the run, slots rising, for the weights as they are (whole numbers throughout)."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    exact = [Fraction(w) for w in weights]
    whole = math.lcm(*(w.denominator for w in exact))
    share = [int(w * whole) for w in exact]
    total, ready, t = sum(share), [], 0
    release = [(0, lane, 0) for lane, n in enumerate(blocks) if n > 0]
    while release or ready:
        if not ready:
            t = max(t, release[0][0])
        while release and release[0][0] <= t:
            _, lane, j = heapq.heappop(release)
            heapq.heappush(ready, (-(-(j + 1) * total // share[lane]), lane, j))
        _, lane, j = heapq.heappop(ready)
        yield lane, j, t
        t += 1
        if j + 1 < blocks[lane]:
            heapq.heappush(release, ((j + 1) * total // share[lane], lane, j + 1))


def _written(spark: SparkSession, schedule: Iterable[tuple[int, int, int]]) -> DataFrame:
    """The schedule as a staged table (lane, block, slot)."""
    path, schema, schedule = shared_dir(spark, "llm", "mix_schedule"), "lane long, block long, slot long", iter(schedule)
    part = list(islice(schedule, BLOCKS_AT_ONCE))
    while True:
        spark.createDataFrame(part, schema).write.mode("append").parquet(path)
        part = list(islice(schedule, BLOCKS_AT_ONCE))
        if not part:
            return spark.read.schema(schema).parquet(path)


def tempered_weights(docs: DataFrame, size: Column, source_col: str = "source", alpha: float = 0.5,
                     max_lanes: int = 256) -> tuple[dict[str | None, float], float]:
    """Target weights size ** alpha: of the ``max_lanes - 1`` largest sources, and the sum of those of all the rest."""
    totals = docs.groupBy(F.col(source_col).alias("s")).agg(F.sum(size.cast("double")).alias("n"))
    totals = totals.withColumn("w", F.pow(F.greatest(F.coalesce("n", F.lit(0.0)), F.lit(1.0)), F.lit(float(alpha))))
    top = totals.orderBy(F.desc("n"), "s").limit(max_lanes - 1).collect()
    rest = (totals.agg(F.sum("w")).first()[0] or 0.0) - sum(r.w for r in top)
    return {r.s: r.w for r in top}, rest if totals.count() > len(top) else 1.0


def source_weights(docs: DataFrame, size: Column, source_col: str = "source", alpha: float = 0.5) -> DataFrame:
    """One row a source, written: source, lane (its number), size (the sum), weight (size ** alpha)."""
    totals = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.coalesce(F.sum(F.coalesce(size, F.lit(0)).cast("long")), F.lit(0)).alias("size"), F.count(F.lit(1)).alias("n"))
    weight = F.pow(F.greatest("size", F.lit(1)).cast("double"), F.lit(float(alpha)))
    return stage(totals.withColumn("lane", F.monotonically_increasing_id()).withColumn("weight", weight), "mix_weights")


def _rows(docs: DataFrame, size: Column, source_col: str) -> DataFrame:
    return docs.select(whole_row(docs), F.col(source_col).cast("string").alias("source"),
                       F.coalesce(size, F.lit(0)).cast("long").alias("size"), row_hash(docs).alias("h"))


def _placed(rows: DataFrame, lane: str, n: int, block_size: int) -> DataFrame:
    """The n rows plus start (size before it in its lane) and block."""
    bits = max(4, math.ceil(math.log2(max(1, n) / PIECE_ROWS + 1)))
    cut = rows.withColumn("bin", F.shiftright("h", 64 - bits))
    placed = running_sum(cut, [lane], "bin", [F.col("h")], F.col("size"), "start")
    return placed.withColumn("block", F.expr(f"start div {int(block_size)}"))


def _with_slots(placed: DataFrame, schedule: DataFrame, keys: list[str], blocks: int) -> DataFrame:
    known = schedule.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in schedule.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    joined = placed.join(F.broadcast(known) if blocks <= BROADCAST_BLOCKS else known, same)
    return joined.select("row", "source", "lane", "block", "slot", "start")


def scheduled(docs: DataFrame, size: Column, weights: DataFrame | dict[str | None, float], rest: float = 1.0, source_col: str = "source",
              block_size: int = 65536, slots: int | None = None) -> DataFrame:
    """Columns: row (a struct of ``docs``' own columns), source, lane, block, slot, start (size before it in its lane)."""
    spark = docs.sparkSession
    if isinstance(weights, DataFrame):
        each = weights.select("lane", "size", "weight", "n").orderBy("lane").toPandas()
        lane, blocks = each["lane"].tolist(), (each["size"] // block_size + 1).tolist()
        dealt = ((lane[i], j, t) for i, j, t in run_schedule(each["weight"].tolist(), blocks)) if blocks else ()
        schedule = _written(spark, dealt).join(weights.select("lane", "source"), "lane")
        placed = _placed(_rows(docs, size, source_col), "source", int(each["n"].sum()), block_size)
        return _with_slots(placed, schedule, ["source", "block"], sum(blocks))
    shares = [*weights.values(), rest]
    last = len(shares) - 1
    lanes = spark.createDataFrame([(s, i) for i, s in enumerate(weights)] or [(None, -1)], "s string, lane int")
    named = _rows(docs, size, source_col).join(F.broadcast(lanes), F.col("source").eqNullSafe(F.col("s")), "left").select(
        "row", "source", "size", "h", F.coalesce("lane", F.lit(last)).alias("lane"))
    placed = _placed(named, "lane", docs.count(), block_size)
    if slots is None:
        sizes = {r.lane: r.n for r in named.groupBy("lane").agg(F.sum("size").alias("n")).collect()}
        blocks = [sizes[i] // block_size + 1 if i in sizes else 0 for i in range(len(shares))]
        return _with_slots(placed, _written(spark, run_schedule(shares, blocks)), ["lane", "block"], sum(blocks))
    counts = frame_counts(shares, slots)
    frame = spark.createDataFrame(frame_schedule(counts), "lane int, turn long, place long")
    per_frame = F.element_at(F.array([F.lit(n) for n in counts]), F.col("lane") + 1)
    return placed.withColumn("per_frame", per_frame).withColumn("turn", F.col("block") % F.col("per_frame")).join(
        F.broadcast(frame), ["lane", "turn"]).select("row", "source", "lane", "block", (F.expr("block div per_frame") * slots + F.col("place")).alias("slot"), "start")


def in_mix_order(docs: DataFrame, size: Column, weights: DataFrame | dict[str | None, float], rest: float = 1.0, **how) -> DataFrame:
    """``docs`` whole, in the order of their slots: partition after partition, and inside each."""
    key = ["slot", "start"]
    return scheduled(docs, size, weights, rest, **how).repartitionByRange(*key).sortWithinPartitions(*key).select("row.*")
