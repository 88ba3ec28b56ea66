"""Exact top-k by inner product, pruned by vector length and direction, for a stated set of query rows.

Vectors are grouped into ``buckets`` by length (quantiles of the length, longest first), large buckets into cells of at
most about ``cell_rows``; queries go in blocks. The longest bucket is searched first: the k-th best product found there
is each query's threshold. A bucket whose longest vector times the query's length falls short of it is not visited at
all. In a visited bucket the threshold over (query length x longest length) is a cosine that any result must reach. Where
that local cosine is high, coordinates prune: of a query's largest coordinates each must lie within the angle that the
cosine allows. Where it is low, length prunes: vectors too short for the threshold are left out, and one matrix product
covers the rest. Every remaining product is computed exactly, and the best k of all cells are merged.

Queries that visit about equally many buckets share blocks, and a bucket's vectors are copied only to the blocks that visit it.

All bounds have slack for rounding and keep ties, so the result is exact: the highest integer products, ties to the
smaller vec_id.

Defined cases: components become floor(64 * x), at most the range of a long; a vector that is null or holds null, NaN or
infinity takes no part; vectors of different dimension do not meet; a product beyond the range of a long counts as its
end; a repeated row is a row of its own, so a query's copy is a candidate and each query row has its own results; a null
vec_id is a candidate that comes last among ties and never a query; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semjoin.llm.common import stage

#: Local cosine from which coordinates prune better than length, and the coordinates looked at.
COORD_FROM, FOCUS = 0.85, 4
SLACK = 1e-6
TILE = 256
_LONG = (1 << 63) - 1
_FOUND = "query_rid long, query_id long, id long, none boolean, score long"


def quantised(embedding: Column) -> Column:
    """floor(64 * x) of each component as array<bigint>; null where the vector takes no part."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(embedding.isNotNull() & fine, F.transform(embedding, lambda x: F.floor(x.cast("double") * 64)))


def _exact(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer products of rows of p with rows of q: in float64 where every sum is exact there, else with big integers."""
    if p.size == 0 or q.size == 0 or float(np.abs(p.astype(float)).max()) * float(np.abs(q.astype(float)).max()) * p.shape[1] < 2.0 ** 52:
        return (p.astype(np.float64) @ q.astype(np.float64).T).astype(np.int64)
    big = p.astype(object) @ q.astype(object).T
    return np.clip(big, -_LONG - 1, _LONG).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _by_coordinates(unit: np.ndarray, q: np.ndarray, cosine: float) -> np.ndarray:
    """Positions of unit vectors that may reach ``cosine`` with the unit vector q, by q's FOCUS largest coordinates."""
    ok, reach = np.ones(len(unit), dtype=bool), math.acos(min(1.0, max(-1.0, cosine - SLACK)))
    for f in np.argsort(-np.abs(q))[:FOCUS]:
        at = math.acos(min(1.0, max(-1.0, q[f])))
        low, high = math.cos(min(math.pi, at + reach)) - SLACK, math.cos(max(0.0, at - reach)) + SLACK
        ok &= (unit[:, f] >= low) & (unit[:, f] <= high)
    return np.flatnonzero(ok)


def search_cell(probes: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best k of a cell for each query, none below the query's threshold (columns rid, id, none, v, norm; theta)."""
    out = []
    for dim, asked in queries.groupby(queries["v"].map(len)):
        own = probes[probes["v"].map(len) == dim].sort_values("norm", ascending=False, kind="stable")
        if own.empty:
            continue
        p, norm, rid = np.stack(own["v"]) if dim else np.zeros((len(own), 0), dtype=np.int64), own["norm"].to_numpy(), own["rid"].to_numpy()
        ids, none = own["id"].to_numpy(), own["none"].to_numpy()
        unit, q_all = p / np.maximum(norm, 1e-300)[:, None], np.stack(asked["v"]) if dim else np.zeros((len(asked), 0), dtype=np.int64)
        theta, q_norm = asked["theta"].to_numpy(dtype=float), asked["norm"].to_numpy()
        local = theta / np.maximum(q_norm * norm[0], 1e-300)          # the cosine to reach; -inf without a threshold
        steep = (local >= COORD_FROM) & (theta > 0)
        alive = ~((theta > 0) & (local > 1 + SLACK))
        need = np.where(theta > 0, theta / np.maximum(q_norm, 1e-300) * (1 - SLACK), -np.inf)
        reach = np.searchsorted(-norm, -need, side="right")           # vectors at least that long come first

        def take(i: int, cand: np.ndarray, scores: np.ndarray) -> None:
            fit = (rid[cand] != asked["rid"].iat[i]) & (scores >= theta[i])
            cand, scores = cand[fit], scores[fit]
            best = _best(scores, ids[cand], k)
            if len(best):
                out.append(pd.DataFrame({"query_rid": asked["rid"].iat[i], "query_id": asked["id"].iat[i], "id": ids[cand[best]],
                                         "none": none[cand[best]], "score": scores[best]}))

        for i in np.flatnonzero(alive & steep):
            cand = _by_coordinates(unit[:reach[i]], q_all[i] / q_norm[i], local[i])
            take(i, cand, _exact(p[cand], q_all[i:i + 1])[:, 0])
        flat = np.flatnonzero(alive & ~steep)
        flat = flat[np.argsort(reach[flat], kind="stable")]
        for at in range(0, len(flat), TILE):
            tile = flat[at:at + TILE]
            products = _exact(p[:reach[tile].max()], q_all[tile])
            for c, i in enumerate(tile):
                take(i, np.arange(reach[i]), products[:reach[i], c])
    if not out:
        return pd.DataFrame({c.split()[0]: pd.Series(dtype="bool" if "boolean" in c else "int64") for c in _FOUND.split(", ")})
    return pd.concat(out, ignore_index=True)


def _search(probes: DataFrame, asked: DataFrame, cells: dict[int, int], blocks: dict[int, int], k: int) -> DataFrame:
    """Search the buckets in ``asked`` (queries with their bucket, block and theta): one task per cell and query block.

    ``cells`` and ``blocks`` give a bucket's cells and the number of query blocks, counted from block 0, that visit it: its
    vectors are copied to those alone.
    """
    cells = {b: n for b, n in cells.items() if blocks.get(b)}
    if not cells:
        return probes.sparkSession.createDataFrame([], _FOUND)
    look = lambda of: F.create_map(*[F.lit(x) for b in cells for x in (b, of[b])])[F.col("bucket")]
    parts = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    here = F.col("bucket").isin(list(cells))
    p = probes.filter(here).withColumn("cell", F.pmod(F.xxhash64("rid"), look(cells))).withColumn("block", parts(look(blocks)))
    q = asked.filter(here).withColumn("cell", parts(look(cells)))
    key = ["bucket", "cell", "block"]
    p = p.select(F.col("bucket").cast("long"), F.col("cell").cast("long"), F.col("block").cast("long"), "rid", "id", "none", "v", "norm")
    q = q.select(F.col("bucket").cast("long"), F.col("cell").cast("long"), F.col("block").cast("long"), "rid", "id", "v", "norm", "theta")
    return p.groupBy(*key).cogroup(q.groupBy(*key)).applyInPandas(lambda a, b: search_cell(a, b, k), _FOUND)


def _by_depth(queries: DataFrame, counts: dict[int, int], buckets: list[int], block_rows: int) -> tuple[DataFrame, dict[int, int]]:
    """Queries with their block, and the blocks that visit each bucket.

    A query visits the first ``depth`` of ``buckets`` (longest first). Queries go in order of depth, the deepest first, and
    depths share a block as long as it holds them, so the blocks that visit a bucket are the first so many.
    """
    groups: list[list[int]] = []
    for depth in sorted(counts, reverse=True):
        if groups and sum(counts[d] for d in groups[-1]) + counts[depth] <= block_rows:
            groups[-1].append(depth)
        else:
            groups.append([depth])
    size = [-(-sum(counts[d] for d in group) // block_rows) for group in groups]
    first = {d: sum(size[:i]) for i, group in enumerate(groups) for d in group}
    width = {d: size[i] for i, group in enumerate(groups) for d in group}
    upto = {b: sum(n for group, n in zip(groups, size) if group[0] > place) for place, b in enumerate(buckets)}
    look = lambda of: F.create_map(*[F.lit(x) for d in of for x in (d, of[d])])[F.col("depth")]
    return queries.withColumn("block", look(first) + F.pmod(F.xxhash64("rid", F.lit(1)), look(width))), upto


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          buckets: int = 16, cell_rows: int = 16384, block_rows: int = 8192) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows for each row for which ``is_query`` (over column vec_id) holds."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("v"),
                          F.monotonically_increasing_id().alias("rid")).filter("v IS NOT NULL")
    squares = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    # a null id sorts after every other and is given back as null
    rows = rows.withColumn("id", F.coalesce("vec_id", F.lit(_LONG))).withColumn("none", F.col("vec_id").isNull())
    rows = stage(rows.withColumn("norm", F.sqrt(squares)), "topk_rows")
    cuts = rows.agg(F.percentile_approx("norm", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] or []
    bucket = sum([(F.col("norm") < c).cast("int") for c in sorted(set(cuts))], F.lit(0))
    rows = stage(rows.withColumn("bucket", bucket), "topk_buckets")
    held = {r.bucket: r for r in rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("longest")).collect()}
    cells = {b: -(-r.n // cell_rows) for b, r in sorted(held.items())}
    queries = rows.filter(is_query & F.col("vec_id").isNotNull())
    own, n = queries.select("rid", "id", "v", "norm"), queries.count()
    lead = next(iter(cells), None)
    found = vectors.sparkSession.createDataFrame([], _FOUND)
    if n:
        unbound, blocks = _by_depth(own.withColumn("depth", F.lit(1)), {1: n}, [lead], block_rows)
        unbound = unbound.withColumn("theta", F.lit(float("-inf"))).withColumn("bucket", F.lit(lead))
        found = stage(_search(rows, unbound, cells, blocks, k), "topk_first")
    rest = {b: c for b, c in cells.items() if b != lead}
    if n and rest:
        floor = _ranked(found, k).filter(F.col("rank") == k).select(F.col("query_rid").alias("rid"), F.col("score").cast("double").alias("theta"))
        asked = own.join(floor, "rid", "left").withColumn("theta", F.coalesce("theta", F.lit(float("-inf"))))
        reach = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(float(held[b].longest)).alias("longest")) for b in rest])
        near = F.filter(reach, lambda s: F.col("norm") * s["longest"] * (1 + SLACK) >= F.col("theta"))
        asked = stage(asked.withColumn("near", F.transform(near, lambda s: s["b"])).withColumn("depth", F.size("near")).filter("depth > 0"), "topk_asked")
        counts = {r.depth: r.n for r in asked.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).collect()}
        if counts:
            visits, blocks = _by_depth(asked, counts, list(rest), block_rows)
            found = found.unionByName(stage(_search(rows, visits.withColumn("bucket", F.explode("near")), rest, blocks, k), "topk_rest"))
    return _ranked(found, k).select("query_id", "rank", F.when(~F.col("none"), F.col("id")).alias("vec_id"), "score")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_rid").orderBy(F.desc("score"), "none", "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
