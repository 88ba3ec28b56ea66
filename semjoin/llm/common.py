"""What several operators share: written intermediate tables, joins that survive a hot key, running sums, survivors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semjoin.session import shared_dir

#: A key is heavy when it holds more than 1 / HEAVY_PARTS of the rows; so there are fewer than HEAVY_PARTS of them.
HEAVY_PARTS = 2048


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_row(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct ``row``, so that columns added beside it can have any name."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of ``docs``; those that Spark cannot hash (maps, variants) enter as their JSON text."""
    plain = lambda kind: "map<" not in kind and "variant" not in kind
    return F.xxhash64(*[F.col(f"`{c}`") if plain(kind) else F.to_json(F.struct(F.col(f"`{c}`"))) for c, kind in docs.dtypes])


def join_counted(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``groups`` (one row per key; ``count`` = that key's rows in ``rows``), whatever the skew.

    Keys with more than ``total / HEAVY_PARTS`` rows, of which there are fewer than HEAVY_PARTS, are broadcast, so their
    rows stay where they are; each of the other keys is small enough for one task of the shuffle join. ``total`` must be
    the row count of ``rows`` and both inputs cheap to read twice (staged). Key columns must not be null.
    """
    heavy = F.col(count) * F.lit(HEAVY_PARTS) > F.lit(total)
    few = groups.filter(heavy)
    hot = rows.join(F.broadcast(few), keys)
    rest = rows.join(F.broadcast(few.select(*keys)), keys, "left_anti").join(groups.filter(~heavy), keys)
    return hot.unionByName(rest)


def running_sum(df: DataFrame, group: list[str], bin_col: str, order: list[Column], value: Column, out: str) -> DataFrame:
    """``df`` plus ``out``: the sum of ``value`` over the rows of the same group that come before this row.

    A prefix scan in two levels, so that a group of any size is spread: ``bin_col`` cuts each group into consecutive
    pieces (it must not decrease along ``order``); the pieces' sums give their offsets, a window inside each piece the
    rest. A task holds one piece at a time, and rows are shuffled once, by (group, bin).
    """
    keys = [*group, bin_col]
    # one key without nulls for window and join, so that they share the shuffle of the rows
    keyed = df.withColumn("_piece", F.to_json(F.struct(*keys)))
    sums = keyed.groupBy("_piece", *keys).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy(bin_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_piece", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = keyed.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(offsets, "_piece").withColumn(out, F.col("_off") + F.col("_in")).drop("_piece", "_off", "_in")


def survivors(docs: DataFrame, winners: DataFrame, **keys: Column) -> DataFrame:
    """The rows of ``docs`` named by ``winners``, whole and with their own columns only, one row per winner.

    ``keys`` gives each key column of ``winners`` as an expression over ``docs``; keys compare null-safely. Where several
    rows agree in all keys (a repeated row) the one with the smallest hash of all its columns stays. The keys travel as
    one JSON text, so that the join and the choice among repeated rows share one shuffle of the rows.
    """
    key = F.to_json(F.struct(*[e.alias(k) for k, e in keys.items()])).alias("key")
    marked = docs.select(whole_row(docs), key, row_hash(docs).alias("hash"))
    wins = winners.select(F.to_json(F.struct(*keys)).alias("key")).distinct()
    first = Window.partitionBy("key").orderBy("hash")
    return marked.join(wins, "key", "left_semi").withColumn("n", F.row_number().over(first)).filter("n = 1").select("row.*")
