"""Placement of rows on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the ``size`` slots (a prime): it starts at one hash of its name and
steps by another. Shards take turns; each claims the first slot in its order that is still free, until none is. So each
shard holds its share of the slots to within one, and adding or removing a shard moves few of the others' slots. The
table has ``size`` rows whatever the data, so it is broadcast, and a row's shard is one lookup of its key's hash.

Defined cases: a null key counts as the empty text; equal keys meet on one shard, and writing splits a shard over many
files, so a key with a third of all rows is no bottleneck; an empty table gives an empty result; extra columns are kept,
whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semjoin.llm.common import whole_row

SIZE = 65537


def lookup_table(shards: list[str], size: int = SIZE) -> list[int]:
    """The shard (its place in ``shards``) of every slot."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("shards must be distinct and no more than size, a prime")
    hashes = [hashlib.md5(s.encode()).digest() for s in shards]
    at = [int.from_bytes(h[:8], "big") % size for h in hashes]
    step = [int.from_bytes(h[8:], "big") % (size - 1) + 1 for h in hashes]
    table, left = [-1] * size, size
    while True:
        for i in range(len(shards)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % size
            table[at[i]] = i
            left -= 1
            if not left:
                return table


def slot_of(key: Column, size: int = SIZE) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(size))


def place(docs: DataFrame, key: Column, shards: list[str], size: int = SIZE) -> DataFrame:
    """Columns: row (a struct of ``docs``' own columns), slot, shard (name)."""
    table = docs.sparkSession.createDataFrame([(i, shards[s]) for i, s in enumerate(lookup_table(shards, size))], "slot long, shard string")
    rows = docs.select(whole_row(docs), slot_of(key, size).alias("slot"))
    return rows.join(F.broadcast(table), "slot").select("row", "slot", "shard")


def write_shards(docs: DataFrame, key: Column, shards: list[str], path: str, files_per_shard: int = 8, size: int = SIZE) -> None:
    """One folder ``shard=<name>`` per shard under ``path``; rows of a shard are dealt over ``files_per_shard`` tasks.

    They are dealt by their place in the input, so repeated rows are spread like any others; give more files the larger
    the shards are. A column of ``docs`` that is itself called ``shard`` is written as ``shard_in``.
    """
    placed = place(docs, key, shards, size).withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(files_per_shard)))
    own = [F.col(f"row.`{c}`").alias("shard_in" if c == "shard" else c) for c in docs.columns]
    rows = placed.repartition(files_per_shard * len(shards), "shard", "part").select(*own, F.col("shard").alias("shard"))
    rows.write.partitionBy("shard").parquet(path)
