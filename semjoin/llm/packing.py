"""Packing into length buckets whose boundaries are optimal for the whole table.

The global histogram of lengths, a cell for each distinct length, goes to the driver, where dynamic programming picks the
``buckets`` boundaries with the least padding in all. It is as long as the table has distinct lengths: D of them take
D * D / 2 units of text at least, so a table of 10 ** 14 has 14 million at most, and real ones far fewer. Inside a bucket,
documents are numbered in a given order and cut into batches of ``token_budget // boundary`` (one at least): every batch,
padded to its boundary, fits the budget unless a single document exceeds it. Documents are never cut or dropped. What
``length`` counts is the caller's choice: tokens, or words as the registered query and the pipeline do.

Numbering a bucket is a prefix scan over pieces of it, so a bucket may hold most of the table.

Defined cases: null and empty texts have length 0 and fall in the first bucket; repeated rows are packed each; ties in
the order may fall either way; an empty table gives an empty result; extra columns are ignored, whatever their names and types.
"""

from __future__ import annotations

import math
from collections import deque
from itertools import accumulate

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semjoin.llm.common import row_hash, running_sum, stage

PIECE_ROWS = 20_000


def word_count(text: Column) -> Column:
    """Runs of non-white-space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def best_boundaries(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Boundaries (at most ``buckets``, rising, the last = lengths[-1]) with the least sum of boundary - length.

    ``counts`` texts have each of the ``lengths`` (distinct, rising). With c and s the numbers and sums of the first i
    lengths, the last bucket of the first j costs top_j * (c_j - c_i) - (s_j - s_i): for each i a line in top_j, of slope
    -c_i. Slopes fall and tops rise, so the lowest lines form a queue and each boundary takes constant time.
    """
    n, c, s = len(lengths), [0], [0]
    for x, k in zip(lengths, counts):
        c.append(c[-1] + k)
        s.append(s[-1] + k * x)
    best: list[int | None] = [0] + [None] * n
    came: list[list[int]] = []
    for _ in range(min(buckets, n)):
        new, choice, lines = [None] * (n + 1), [0] * (n + 1), deque()
        new[0] = 0
        for j in range(1, n + 1):
            i = j - 1
            if best[i] is not None:
                high = best[i] + s[i]
                # drop lines that are nowhere the lowest between their neighbours
                while len(lines) > 1 and (high - lines[-2][1]) * (lines[-1][2] - lines[-2][2]) <= (lines[-1][1] - lines[-2][1]) * (c[i] - lines[-2][2]):
                    lines.pop()
                lines.append((i, high, c[i]))
            top = lengths[j - 1]
            while len(lines) > 1 and lines[1][1] - top * lines[1][2] <= lines[0][1] - top * lines[0][2]:
                lines.popleft()
            if lines:
                new[j], choice[j] = top * c[j] - s[j] + lines[0][1] - top * lines[0][2], lines[0][0]
        best = new
        came.append(choice)
    out, j = [], n
    for choice in reversed(came):
        if j == 0:
            break
        out.append(lengths[j - 1])
        j = choice[j]
    return out[::-1]


def file_order(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of ``docs`` plus their rows' place in the Parquet files that they were read from: part and row.

    A column of ``docs`` may be called ``_metadata``. Rows from elsewhere are written first, in the order they have.
    """
    try:
        meta = docs.metadataColumn("_metadata")
    except AnalysisException:
        docs = stage(docs.select(*columns), "packing_in")
        columns, meta = tuple(F.col(c) for c in docs.columns), docs.metadataColumn("_metadata")
    name = meta["file_name"]
    number = F.regexp_extract(name, "^part-([0-9]+)", 1)
    part = F.struct(F.when(number != "", number.cast("long")).alias("no"), name.alias("file")).alias("part")
    return docs.select(*columns, part, meta["row_index"].alias("row"))


def pack(docs: DataFrame, length: Column, token_budget: int = 16384, buckets: int = 12, id_col: str = "doc_id",
         keep_file_order: bool = False, unit: str = "n_words") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words (or what ``length`` counts: ``unit``), bucket, bucket_max, batch_id (unique over buckets), position.

    Batches fill in the order of the files that ``docs`` were read from (``keep_file_order``), else in the order of a
    hash of the row.
    """
    doc_id, n = F.col(id_col).alias("doc_id"), F.coalesce(length, F.lit(0)).cast("long").alias("size")
    if keep_file_order:
        rows = file_order(docs, doc_id, n).select("doc_id", "size", F.struct("part", F.shiftright("row", 14).alias("piece")).alias("bin"), F.col("row").alias("rank"))
    else:
        bits = max(4, math.ceil(math.log2(max(1, docs.count()) / PIECE_ROWS + 1)))
        h = row_hash(docs)
        rows = docs.select(doc_id, n, F.shiftright(h, 64 - bits).alias("bin"), h.alias("rank"))
    rows = stage(rows, "packing")
    cells = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("size")
    lengths, counts = cells["size"].tolist(), cells["n"].tolist()
    bounds = best_boundaries(lengths, counts, buckets) if lengths else [0]
    held = [sum(k for x, k in zip(lengths, counts) if low < x <= high) for low, high in zip([-1, *bounds], bounds)]
    room = [max(1, token_budget // max(1, b)) for b in bounds]
    first = list(accumulate([0, *[-(-h // r) for h, r in zip(held, room)]]))
    per_bucket = F.array([F.struct(F.lit(b).cast("long").alias("top"), F.lit(r).cast("long").alias("room"), F.lit(f).cast("long").alias("first"))
                          for b, r, f in zip(bounds, room, first)])
    bucket = sum([(F.col("size") > b).cast("int") for b in bounds], F.lit(0))
    at = running_sum(rows.withColumn("bucket", bucket), ["bucket"], "bin", [F.col("rank")], F.lit(1), "place")
    at = at.withColumn("b", F.element_at(per_bucket, F.col("bucket") + 1))
    return at.select("doc_id", F.col("size").alias(unit), "bucket", F.col("b.top").alias("bucket_max"),
                     (F.col("b.first") + F.expr("place div b.room")).alias("batch_id"), (F.col("place") % F.col("b.room")).alias("position"))
