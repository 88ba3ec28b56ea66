"""SimHash near-duplicate detection with pigeonring candidate filtering.

Fingerprint (64 bits): lower-case A-Z, words are runs of non-white-space bytes, shingles of ``width`` words (repeats
count); bit i is set when it is set in over half of the shingles' XXH64 (seed 42) values. Two texts are linked when
their fingerprints differ in at most ``max_bits`` bits; groups are the connected components of the links.

Candidates: a fingerprint is a ring of SEGMENTS segments. If two differ in t <= max_bits bits in all, some start on the
ring exists from which every chain of l consecutive segments differs in at most l * max_bits / SEGMENTS bits. While
that budget is below one bit the chain must be equal: this run of segments, for each start, is the join key. The rest
of the chain is tested at each length where the budget steps up, and the full distance last.

Equal fingerprints are collapsed first, so copies never pair up. A key shared by more than ``cap`` fingerprints is not
paired: its fingerprints are linked exactly another way, through the values between them (see ``_linked_by_midpoints``),
whose groups have a fixed largest size. So the work is linear in the number of distinct fingerprints, no link is lost
and none is added.

Defined cases: null and empty texts have no word and fingerprint zero, linked like any other; fewer words than
``width`` make one shingle of all; null ids get a component like any row but never name one (a component of null ids
only has a null ``component_id``); repeated rows share fingerprint and component; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semjoin.llm.common import join_counted, stage, survivors
from semjoin.llm.components import connected_components

BITS = 64
SEGMENTS = 16
SEED = 42
#: Words of a text that are hashed at a time, so that a very long text needs bounded memory besides itself.
WORDS_AT_ONCE = 200_000


def fingerprint_of(text: str | None, width: int) -> int:
    """The unsigned fingerprint of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ones, n = np.zeros(BITS, dtype=np.int64), max(1, len(words) - width + 1)
    for at in range(0, n, WORDS_AT_ONCE):
        part = words[at:min(at + WORDS_AT_ONCE, n) + width - 1]
        ends = np.cumsum([len(w) + 1 for w in part])
        joined, last = b" ".join(part), min(width, len(part)) - 1
        starts = [0, *ends[:len(part) - 1 - last].tolist()]
        hash_of = xxhash.xxh64_intdigest
        h = np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts, (ends[last:] - 1).tolist())], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: Column, width: int) -> Column:
    """``text``'s fingerprint as a long with the same 64 bits."""
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint_of(t, width) for t in texts], dtype=np.uint64).view(np.int64))
    return of(text)


def _budgets(max_bits: int) -> list[int]:
    """Bits that a viable chain of 1, 2, ... SEGMENTS segments may differ in."""
    return [length * max_bits // SEGMENTS for length in range(1, SEGMENTS + 1)]


def _rotated(fp: Column, start: Column) -> Column:
    """``fp`` with segment ``start`` moved to the low end."""
    by = start * (BITS // SEGMENTS)
    return F.call_function("shiftrightunsigned", fp, by).bitwiseOR(F.call_function("shiftleft", fp, F.lit(BITS) - by))


def _low(bits: int) -> Column:
    return F.lit(-1 if bits >= BITS else (1 << bits) - 1).cast("long")


def _keyed(fps: DataFrame, max_bits: int) -> DataFrame:
    """Each fingerprint under the key of each start: the run of segments that must be equal, and the start."""
    equal = sum(b == 0 for b in _budgets(max_bits)) * (BITS // SEGMENTS)
    starts = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS - 1))).alias("start"))
    return starts.select("fp", "start", _rotated(F.col("fp"), F.col("start")).bitwiseAND(_low(equal)).alias("run"))


def _viable(x: Column, y: Column, start: Column, max_bits: int) -> Column:
    """The chain test at the last length of every budget, from ``start``; the last one is the full Hamming distance."""
    budgets, diff = _budgets(max_bits), x.bitwiseXOR(y)
    turned = _rotated(diff, start)
    ok = F.lit(True)
    for i, b in enumerate(budgets):
        if i + 1 == len(budgets) or budgets[i + 1] > b:
            ok = ok & (F.bit_count(turned.bitwiseAND(_low((i + 1) * (BITS // SEGMENTS)))) <= b)
    return ok


def _linked_by_midpoints(fps: DataFrame, max_bits: int) -> DataFrame:
    """Pairs that connect exactly the fingerprints within ``max_bits`` (0 to 3) of each other, without pairing them up.

    Two fingerprints differ in at most 2 bits exactly when some value is within 1 bit of both, in at most 1 when they
    agree after clearing some bit, in at most 3 when values within 1 bit of each so agree. Such a value is shared by
    130 fingerprints at most, and everyone who shares it is linked to the smallest.
    """
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    each = F.sequence(F.lit(0), F.lit(BITS - 1))
    keys = fps.select("fp", F.col("fp").alias("z"))
    if max_bits >= 2:
        keys = keys.unionByName(fps.select("fp", F.explode(each).alias("i")).select("fp", F.col("fp").bitwiseXOR(bit(F.col("i"))).alias("z")))
    if max_bits % 2:
        keys = keys.select("fp", "z", F.explode(each).alias("i")).select("fp", F.col("z").bitwiseAND(F.bitwise_not(bit(F.col("i")))).alias("z"), "i")
    by = ["z", "i"] if max_bits % 2 else ["z"]
    met = keys.groupBy(*by).agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    return met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")


def links(fps: DataFrame, max_bits: int = 2, cap: int = 64) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints (column fp, staged) whose components are those of all links."""
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3")
    by = ["start", "run"]
    sizes = stage(_keyed(fps, max_bits).groupBy(*by).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash_keys")
    shared = stage(join_counted(_keyed(fps, max_bits), sizes, by, "n", SEGMENTS * fps.count()), "simhash_shared")
    lists = shared.filter(F.col("n") <= cap).groupBy(*by).agg(F.collect_list("fp").alias("fps"))
    near = F.transform("fps", lambda x: F.transform(
        F.filter("fps", lambda y: (x < y) & _viable(x, y, F.col("start"), max_bits)), lambda y: F.struct(x.alias("a"), y.alias("b"))))
    pairs = lists.select(F.explode(F.flatten(near)).alias("p")).select("p.a", "p.b")
    crowded = shared.filter(F.col("n") > cap).select("fp").distinct()
    return pairs.unionByName(_linked_by_midpoints(crowded, max_bits)).distinct()


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2, cap: int = 64,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key (a hash of the text), fp, fingerprint (hex), component_id, stays.

    ``component_id`` is the smallest id reachable over links; ``stays`` marks one row of each component, the one with
    that id (of several, or of null ids only, the first read).
    """
    rows = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_key"),
                             F.monotonically_increasing_id().alias("rid"), fingerprint(F.col(text_col), width).alias("fp")), "simhash")
    classes = stage(rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first"),
                                           F.count(F.lit(1)).alias("n")), "simhash_classes")
    found = connected_components(links(classes.select("fp"), max_bits, cap))
    rooted = stage(classes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
                   .withColumn("root", F.coalesce("root", "fp")), "simhash_roots")
    groups = stage(rooted.groupBy("root").agg(F.min("first").alias("lead"), F.count(F.lit(1)).alias("members")), "simhash_groups")
    named = stage(join_counted(rooted, groups, ["root"], "members", classes.count()).select("fp", "n", "lead"), "simhash_named")
    out = join_counted(rows, named, ["fp"], "n", rows.count())
    return out.select("doc_id", "text_key", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                      F.col("lead.doc_id").alias("component_id"), (F.col("rid") == F.col("lead.rid")).alias("stays"))


def keep_one_of_each(docs: DataFrame, width: int = 3, max_bits: int = 2, cap: int = 64,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole: one of each component."""
    won = near_duplicates(docs, width, max_bits, cap, id_col, text_col).filter("stays")
    return survivors(docs, won, doc_id=F.col(id_col).cast("long"), text_key=F.xxhash64(F.col(text_col)))
