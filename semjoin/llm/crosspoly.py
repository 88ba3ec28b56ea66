"""Embedding near-duplicates by cross-polytope hashing: fast Hadamard rotations, multiprobe buckets, verified pairs.

A vector is hashed by turning it at random (three rounds of random signs and a fast Hadamard transform) and taking the
corner of the cross-polytope that it then lies next to: the place of its largest component, and that component's sign.
``hashes`` such corners make the code of a table. A vector lives in the bucket of its code and also probes the
``PROBES - 1`` next likeliest ones, those whose corners it misses by least. Two vectors meet in a bucket where one of
them lives and the other lives or probes. The number of tables is the least that lets a pair at just the wanted cosine
meet with probability ``RECALL`` by simulation (more similar pairs meet more often); ``hashes`` grows with the logarithm
of the number of vectors, so that no bucket is expected to hold more than BUCKET_ROWS of evenly spread ones.

Pairs are verified where they meet, by one matrix product a cell, and never leave it: a cell returns for each vector how
many links it found and one vector of its group, so what moves is in proportion to the vectors, not to the pairs. A pair
that meets several times is counted in the first of its meeting places alone, which both codes tell. Buckets of more than
CELL_ROWS vectors are cut into blocks, and each pair of blocks is a cell of its own, so a crowded bucket is spread over
tasks (blocks are smaller for vectors beyond 64 dimensions). Equal vectors are one vector with a weight. Groups are the connected components of the links.

Defined cases: a vector that is null or zero, or that holds null, NaN or infinity, links with nothing; vectors of
different dimension do not meet; equal vectors always link (copies of a row too, each a vector of its own); a null id
takes part but never names a component, unless all ids in it are null; an empty table gives an empty result; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semjoin.llm.common import join_counted, stage
from semjoin.llm.components import connected_components

PROBES, RECALL = 4, 0.99
BUCKET_ROWS, CELL_ROWS = 65536, 8192
#: Crowded buckets up to which their list is broadcast.
BROADCAST_BUCKETS = 200_000
#: Pairs, and cells of a product, that are looked at together.
PAIRS_AT_ONCE, CELLS_AT_ONCE = 1 << 17, 1 << 22
_SIMULATED = 4000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal fast Hadamard transform of each row; the rows' length is a power of two."""
    n, width, step = len(x), x.shape[1], 1
    while step < width:
        x = x.reshape(n, width // (2 * step), 2, step)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


class Hashing:
    """The tables for vectors of dimension ``dim`` of which there are ``n``; the same on every worker."""

    def __init__(self, dim: int, n: int, cosine: float):
        self.dim, self.width = dim, max(8, 1 << (dim - 1).bit_length())
        self.hashes = max(1, math.ceil(math.log(max(n, 1) / BUCKET_ROWS, 2 * self.width)))
        self.signs = np.random.default_rng([dim, 11]).choice([-1.0, 1.0], size=(64 * self.hashes, 3, self.width))
        met = self._simulated(cosine)
        self.tables = min(64, max(1, math.ceil(math.log(1 - RECALL) / math.log(max(1e-9, 1 - met)))))

    def _simulated(self, cosine: float) -> float:
        """The share of random pairs at ``cosine`` that meet in a table."""
        rng = np.random.default_rng([self.dim, 12])
        x, y = rng.normal(size=(2, _SIMULATED, self.dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        y -= (x * y).sum(1, keepdims=True) * x
        y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
        a, b = self._table(x, 0), self._table(cosine * x + math.sqrt(1 - cosine ** 2) * y, 0)
        return float(((a[:, :1] == b).any(1) | (b[:, :1] == a).any(1)).mean())

    def _table(self, unit: np.ndarray, table: int) -> np.ndarray:
        """Codes of unit vectors in a table: the own one first, then the probed ones (PROBES in all)."""
        padded = np.zeros((len(unit), self.width))
        padded[:, :self.dim] = unit
        code, miss = np.zeros((len(unit), 1), dtype=np.int64), np.zeros((len(unit), 1))
        for k in range(self.hashes):
            z = padded
            for signs in self.signs[table * self.hashes + k]:
                z = hadamard(z * signs)
            size = np.abs(z)
            best = np.argsort(-size, axis=1, kind="stable")[:, :PROBES]
            corner = 2 * best + (np.take_along_axis(z, best, 1) < 0)
            size = np.take_along_axis(size, best, 1)
            code = (code[:, :, None] * (2 * self.width) + corner[:, None, :]).reshape(len(unit), -1)
            miss = (miss[:, :, None] + ((size[:, :1] - size) ** 2)[:, None, :]).reshape(len(unit), -1)
        likely = np.argsort(miss, axis=1, kind="stable")[:, :PROBES]
        return np.take_along_axis(code, likely, 1)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """The codes of each vector: PROBES of the first table, of the second, and so on."""
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.concatenate([self._table(unit, t) for t in range(self.tables)], axis=1)


@functools.lru_cache(maxsize=64)
def hashing(dim: int, n: int, cosine: float) -> Hashing:
    return Hashing(dim, n, cosine)


def _scaled(v: np.ndarray) -> np.ndarray:
    """Vectors in float64, each divided by its largest component (a power of two near it), so that squares stay in range."""
    v = v.astype(np.float64)
    return np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1])


class _Cell:
    """The vectors of one cell and what has been found about them."""

    def __init__(self, rows: pd.DataFrame, table: int, bucket: int, cosine: float):
        self.table, self.bucket, self.cosine = table, bucket, cosine
        self.v = _scaled(np.stack(rows["v"]))
        self.norm = np.sqrt((self.v * self.v).sum(1))
        self.codes = np.stack(rows["codes"]).reshape(len(rows), -1, PROBES)
        self.weight, self.links = rows["m"].to_numpy(), np.zeros(len(rows), dtype=np.int64)
        self.root = np.arange(len(rows))

    def compare(self, a: np.ndarray, b: np.ndarray, same: bool = False) -> None:
        """Look at every pair of a vector in ``a`` and one in ``b`` (with ``same``, both being one list, at each once)."""
        tall = max(1, CELLS_AT_ONCE // max(1, len(b)))
        for at in range(0, len(a), tall):
            part = a[at:at + tall]
            cosine = (self.v[part] @ self.v[b].T) / (self.norm[part][:, None] * self.norm[b][None, :])
            i, j = np.nonzero(cosine >= self.cosine)
            if same:
                once = at + i < j
                i, j = i[once], j[once]
            for some in range(0, len(i), PAIRS_AT_ONCE):
                self._take(part[i[some:some + PAIRS_AT_ONCE]], b[j[some:some + PAIRS_AT_ONCE]])

    def _take(self, x: np.ndarray, y: np.ndarray) -> None:
        own_x, own_y = self.codes[x, :, 0], self.codes[y, :, 0]
        first = np.ones(len(x), dtype=bool)
        for t in range(self.table):
            first &= ~((own_x[:, t, None] == self.codes[y, t]).any(1) | (own_y[:, t, None] == self.codes[x, t]).any(1))
        # in this table they may also meet where the other one lives; the lower of the two buckets counts
        both = (own_x[:, self.table, None] == self.codes[y, self.table]).any(1) & (own_y[:, self.table, None] == self.codes[x, self.table]).any(1)
        first &= ~both | (np.minimum(own_x[:, self.table], own_y[:, self.table]) == self.bucket)
        np.add.at(self.links, x[first], self.weight[y[first]])
        np.add.at(self.links, y[first], self.weight[x[first]])
        while True:
            a, b = self.root[x], self.root[y]
            if (a == b).all():
                return
            low = np.minimum(a, b)
            np.minimum.at(self.root, a, low)
            np.minimum.at(self.root, b, low)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


_FOUND = "cid long, links long, root long"


def _search(cosine: float):
    def search(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, table, bucket, low, high = key
        cell = _Cell(rows, int(table), int(bucket), cosine)
        lives, first = rows["lives"].to_numpy(), rows["block"].to_numpy() == low
        if low == high:
            cell.compare(np.flatnonzero(lives), np.flatnonzero(lives), same=True)
            cell.compare(np.flatnonzero(lives), np.flatnonzero(~lives))
        else:
            cell.compare(np.flatnonzero(lives & first), np.flatnonzero(~first))
            cell.compare(np.flatnonzero(~lives & first), np.flatnonzero(lives & ~first))
        cid = rows["cid"].to_numpy()
        some = np.flatnonzero((cell.links > 0) | (cell.root != np.arange(len(rows))))
        return pd.DataFrame({"cid": cid[some], "links": cell.links[some], "root": cid[cell.root[some]]})
    return search


def _coded(classes: DataFrame, n: int, cosine: float) -> DataFrame:
    @F.pandas_udf("array<long>")
    def codes(v: pd.Series) -> pd.Series:
        out, dims = pd.Series([None] * len(v), index=v.index, dtype=object), v.map(len)
        for dim in dims.unique():
            own = dims.index[dims == dim]
            got = hashing(int(dim), n, cosine).codes(_scaled(np.stack(v[own])))
            out[own] = list(got)
        return out
    return classes.withColumn("codes", codes("v"))


def links(classes: DataFrame, cosine: float, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(cid, links, root) for ``classes`` (cid, v, m; staged): weights of the vectors that each cell linked to cid, and one it is connected with."""
    coded = stage(_coded(classes, classes.count(), cosine), "near_codes")
    met = coded.select("cid", "m", "v", "codes", F.size("v").alias("dim"), F.posexplode("codes").alias("place", "bucket"))
    met = met.withColumn("t", F.expr(f"place div {PROBES}")).withColumn("lives", F.col("place") % PROBES == 0).drop("place")
    key = ["dim", "t", "bucket"]
    sizes = stage(met.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), "near_buckets")
    most = F.greatest(F.lit(256), F.floor(F.lit(64.0 * cell_rows) / F.greatest("dim", F.lit(64)))) if cell_rows >= 256 else F.lit(cell_rows)
    crowded = sizes.filter(F.col("n") > most)
    if crowded.count() <= BROADCAST_BUCKETS:
        met = met.join(F.broadcast(crowded), key, "left")
    else:
        met = join_counted(met, sizes, key, "n", coded.agg(F.sum(F.size("codes"))).first()[0])
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / most)
    met = met.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    cells = met.select(*key, "low", "high", "block", "cid", "m", "lives", "v", "codes").groupBy(*key, "low", "high")
    return stage(cells.applyInPandas(_search(cosine), _FOUND), "near_links")


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding",
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other vectors linked directly), component_id, kept (vec_id is it)."""
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    v = F.col(vector_col)
    usable = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(usable, v).alias("v"), F.monotonically_increasing_id().alias("rid"))
    rows = stage(rows, "near_rows")
    own = rows.filter("v IS NOT NULL")
    classes = own.groupBy("v").agg(F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "rid")).alias("lead"), F.count(F.lit(1)).alias("m"))
    classes = stage(classes.withColumn("cid", F.col("lead.rid")), "near_classes")
    found = links(classes.select("cid", "v", "m"), cosine, cell_rows)
    per_class = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected_components(found.filter("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")))
    rooted = classes.join(per_class, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    rooted = stage(rooted.select("cid", "v", "m", "lead", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "cid").alias("root")), "near_roots")
    groups = stage(rooted.groupBy("root").agg(F.min("lead").alias("first"), F.count(F.lit(1)).alias("members")), "near_groups")
    named = stage(join_counted(rooted.drop("lead"), groups, ["root"], "members", classes.count()).select("v", "m", "links", "first"), "near_named")
    linked = join_counted(own, named, ["v"], "m", own.count()).select("vec_id", (F.col("links") + F.col("m") - 1).alias("n_links"), F.col("first.vec_id").alias("component_id"))
    alone = rows.filter("v IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
