"""Nearest-catalogue-entry matching (top-1 by cosine similarity).

Four physical strategies, one contract: for every left row, the catalogue row
with the highest cosine similarity (ties: lowest id), or NULLs when the
catalogue is empty, the left vector is NULL/zero/of the wrong length, or the
best similarity is below the threshold.

* ``broadcast`` (default when the catalogue fits the budget): the catalogue is
  counted, its size checked, then collected and shipped once per executor as a normalised
  matrix. A scalar Arrow UDF takes only the vector column; Spark keeps the
  other columns in the JVM and zips the result back, so the left side is never
  shuffled and no pair rows exist - each Arrow batch is one matrix product.
* ``bounded`` (beyond the budget): the lists of ``ivf``, about as many as there
  would be catalogue blocks of ``cat_block_rows``. Lists that lie near each other
  share a co-group of up to CAT_BLOCK_ROWS catalogue rows, and a left row goes
  once to a co-group, if one of its lists can reach the threshold and the best so
  far; so small lists make the bounds finer, not the shuffle larger. One block
  of catalogue has nothing to leave out and goes by ``blocked``.
* ``blocked``: both sides are cut into bounded blocks by
  hashing keys, a block of left rows meets a block of catalogue rows through a
  co-grouped shuffle (equi-key ``list_id, salt, block``), each group emits only
  its per-left-row best, and ``max_by`` with partial aggregation merges blocks.
* ``ivf`` (opt-in, an inverted-list index): k-means lists over the active
  catalogue, each with its radius (the largest angle of a member to the
  centroid). A left row at angle a to a centroid can find nothing better there
  than cos(a - radius), so lists are visited in the order of this bound,
  ``nprobe`` at first and PROBE_GROWTH times as many in each further round,
  until no unvisited list can reach the best found: the answer is exact, and
  rows near their match leave early. ``rounds`` stops after so many, which
  makes the search approximate.

Similarities are computed in double from the stored float vectors. Ties are
decided on the similarity rounded to ``TIE_DECIMALS`` so that BLAS summation
order cannot flip two equal candidates.
"""

from __future__ import annotations

import contextlib
import math
import threading
import uuid
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semjoin.functions.vectors import vector_dim_ok
from semjoin.operators.partitioning import materialize_python
from semjoin.session import ensure_checkpoint_dir

# Fixed values matching the matcher's defaults: threshold, and the inverted-list index
# (200 lists).
DEFAULT_THRESHOLD = 0.5
DEFAULT_NLIST = 200
# Ours: lists that a row visits in the first round, the growth from round to round, and the slack of a list's bound.
DEFAULT_NPROBE = 8
PROBE_GROWTH = 4
BOUND_SLACK = 1e-6
TIE_DECIMALS = 12

# Ours: most lists of the bounded search (their centroids are broadcast), and catalogue rows that train lists, about.
MAX_LISTS = 4096
TRAIN_ROWS = 500_000

# Operational bounds (ours).
DEFAULT_BROADCAST_BYTES = 512 * 1024 * 1024   # catalogue matrix shipped to executors
# Texts that enrich broadcasts. The driver collects them, builds a hash table of them and keeps its blocks: some four times their size.
TEXT_BROADCAST_BYTES = 32 * 1024 * 1024
SIM_CHUNK_CELLS = 1 << 20                     # rows x catalogue cells per matrix product (4 MB: stays near the caches)
SIM_CHUNK_ROWS = 512                          # left rows of one product
# A co-group of the blocked path holds at most BLOCK_ROWS + CAT_BLOCK_ROWS rows. Its shuffle
# moves n_left * n_cat * (1 / CAT_BLOCK_ROWS + 1 / BLOCK_ROWS) rows for a large list, least
# when the two are equal; a small list gives its unused catalogue allowance to the left side.
BLOCK_ROWS = 60000                            # left rows in one co-group
CAT_BLOCK_ROWS = 60000                        # catalogue rows in one co-group
LEFT_BATCH_ROWS = 8192                        # left rows of a co-group that are taken to float64 at a time

MATCH_TYPE = T.StructType([
    T.StructField("market_id", T.LongType()),
    T.StructField("similarity", T.DoubleType()),
])


# --------------------------------------------------------------------------- kernels (numpy, in tasks)

def _stack(vectors, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrow list column -> (unit rows float64, valid mask). Invalid rows are zero."""
    n = len(vectors)
    try:   # fast path: every row present with the right length
        out = np.stack(vectors).astype(np.float64)
        if out.shape != (n, dim) or not np.isfinite(out).all():
            raise ValueError
        norms = np.linalg.norm(out, axis=1)
        ok = norms > 0
        out[ok] /= norms[ok, None]
        out[~ok] = 0.0
        return out, ok
    except (ValueError, TypeError):
        pass
    out = np.zeros((n, dim), dtype=np.float64)
    ok = np.zeros(n, dtype=bool)
    for i, v in enumerate(vectors):
        if v is None:
            continue
        a = np.asarray(v, dtype=np.float64)
        if a.shape != (dim,) or not np.isfinite(a).all():
            continue
        out[i] = a
        ok[i] = True
    norms = np.linalg.norm(out, axis=1)
    ok &= norms > 0
    out[ok] /= norms[ok, None]
    out[~ok] = 0.0
    return out, ok


def _stack_arrow(arr, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Arrow list array -> (unit rows float64, valid mask), read from the flat value buffer."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    lengths = pc.fill_null(pc.list_value_length(arr), -1).to_numpy(zero_copy_only=False)
    ok = lengths == dim
    out = np.zeros((n, dim), dtype=np.float64)
    if ok.any():
        rows = arr if ok.all() else arr.filter(pa.array(ok))
        out[ok] = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    finite = np.isfinite(out).all(axis=1)
    out[~finite] = 0.0
    norms = np.linalg.norm(out, axis=1)
    ok &= finite & (norms > 0)
    out[ok] /= norms[ok, None]
    out[~ok] = 0.0
    return out, ok


# A float32 product of unit vectors is within ~dim * 6e-8 of the exact value; every
# catalogue row scoring within RESCORE_MARGIN of a row's float32 maximum is rescored
# exactly in float64, so the answer equals the exact one (margin covers dim <= 10k).
RESCORE_MARGIN = 1e-3
# Ours: bytes of the float64 copies held while rescoring. Near-duplicate catalogues make
# every row a candidate, so candidates are rescored in slices of this size.
RESCORE_BYTES = 4 * 1024 * 1024
NORM_ROWS = 1 << 16       # catalogue rows whose norms are computed at a time


def _reciprocal_norms(mat: np.ndarray) -> np.ndarray:
    """1 / length of every row in float64, from float64 copies of NORM_ROWS rows at a time."""
    out = np.empty(len(mat), dtype=np.float64)
    for lo in range(0, len(mat), NORM_ROWS):
        out[lo:lo + NORM_ROWS] = 1.0 / np.linalg.norm(mat[lo:lo + NORM_ROWS].astype(np.float64), axis=1)
    return out


def _candidate_slices(mask: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, column) indices of the true cells, in slices of at most ``most`` cells."""
    ends = np.cumsum(np.count_nonzero(mask, axis=1))
    start = 0
    while start < len(mask):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        r, c = np.nonzero(mask[start:end])
        for lo in range(0, len(r), most):            # more than one slice only for a single row
            yield r[lo:lo + most] + start, c[lo:lo + most]
        start = end


def _best(x: np.ndarray, ok: np.ndarray, ids: np.ndarray, cat: np.ndarray, inv_norm: np.ndarray | None = None):
    """Per row of ``x``: (index into ids, similarity) of the best catalogue row; -1 when none.

    ``x`` holds unit rows (float64). ``cat`` holds the stored float32 vectors
    sorted by id and ``inv_norm`` their reciprocal norms (float64); without
    ``inv_norm`` the rows of ``cat`` are taken as already unit length. Rows and
    catalogue are walked in tiles: a tile's row is looked at again only if its
    float32 maximum comes within RESCORE_MARGIN of the best so far, and its
    cells that do are rescored. Besides its arguments it holds SIM_CHUNK_CELLS
    float32 products and RESCORE_BYTES of candidates, however many there are.
    """
    n = x.shape[0]
    best_i = np.full(n, -1, dtype=np.int64)
    best_s = np.full(n, np.nan, dtype=np.float64)
    m = cat.shape[0]
    if m == 0 or n == 0:
        return best_i, best_s
    if inv_norm is None:
        inv_norm = np.ones(m, dtype=np.float64)
    cat32 = cat.astype(np.float32, copy=False)
    rows_per = min(n, SIM_CHUNK_ROWS)
    cols_per = min(m, max(1, SIM_CHUNK_CELLS // rows_per))
    most = max(1, RESCORE_BYTES // (16 * cat.shape[1]))
    products = np.empty(rows_per * cols_per, dtype=np.float32)
    for lo in range(0, n, rows_per):
        xs = x[lo:lo + rows_per]
        xs32 = xs.astype(np.float32)
        near = np.full(len(xs), -np.inf, dtype=np.float32)           # running best, float32
        top = np.full(len(xs), -np.inf)                              # running best, rounded
        for left in range(0, m, cols_per):
            tile = cat32[left:left + cols_per] * inv_norm[left:left + cols_per, None].astype(np.float32)
            approx = np.matmul(xs32, tile.T, out=products[:len(xs) * len(tile)].reshape(len(xs), len(tile)))  # fast pass, float32
            highest = approx.max(axis=1)
            near = np.maximum(near, highest)
            again = np.flatnonzero(highest >= near - RESCORE_MARGIN)
            for some in np.array_split(again, -(-len(again) // max(1, RESCORE_BYTES // (8 * len(tile))))) if len(again) else ():
                mask = approx[some] >= (near[some] - RESCORE_MARGIN)[:, None]
                for r, c in _candidate_slices(mask, most):
                    r, c = some[r], c + left
                    exact = np.einsum("ij,ij->i", xs[r], cat32[c].astype(np.float64)) * inv_norm[c]
                    rounded = np.round(exact, TIE_DECIMALS)
                    # best per row: highest rounded similarity, then lowest id (columns are sorted by id)
                    order = np.lexsort((c, -rounded, r))
                    first = np.ones(len(order), dtype=bool)
                    first[1:] = r[order][1:] != r[order][:-1]
                    pick = order[first]
                    pick = pick[rounded[pick] > top[r[pick]]]        # a later slice holds higher ids: ties stay
                    top[r[pick]] = rounded[pick]
                    best_i[lo + r[pick]] = c[pick]
                    best_s[lo + r[pick]] = exact[pick]
    best_i[~ok] = -1
    best_s[~ok] = np.nan
    return best_i, best_s


_CATALOGUE_CACHE: dict = {}


def _catalogue_from_broadcast(bc, dim: int):
    """(ids, float32 vectors, float64 reciprocal norms), prepared once per Python worker per broadcast.

    The cache is keyed by a token created with the broadcast (reused workers
    serve many queries, so object identity is not a safe key). Only the
    float32 matrix is kept: a worker holds about ``rows x dim x 4`` bytes.
    """
    token, ids, mat = bc.value
    got = _CATALOGUE_CACHE.get(token)
    if got is None:
        inv = _reciprocal_norms(mat)
        _CATALOGUE_CACHE.clear()
        _CATALOGUE_CACHE[token] = got = (ids, np.ascontiguousarray(mat, dtype=np.float32), inv)
    return got


def _broadcast_udf(bc, dim: int):
    @F.arrow_udf(MATCH_TYPE)
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids, cat, inv = _catalogue_from_broadcast(bc, dim)
        for vs in batches:
            x, ok = _stack_arrow(vs, dim)
            bi, bs = _best(x, ok, ids, cat, inv)
            none = bi < 0
            yield pa.StructArray.from_arrays([pa.array(ids[np.maximum(bi, 0)], mask=none), pa.array(bs, mask=none)],
                                             names=["market_id", "similarity"])
    # non-deterministic only for the optimizer: keeps filters above the matrix
    # product instead of copying the call into them
    return nearest.asNondeterministic()


# --------------------------------------------------------------------------- broadcast lifetime

_TRACKING = threading.local()


def _track(bc):
    items = getattr(_TRACKING, "items", None)
    if items is not None:
        items.append(bc)
    return bc


@contextlib.contextmanager
def released_broadcasts():
    """Broadcasts made by ``nearest`` inside the block are released from the executors when it ends.

    A stream broadcasts the catalogue of every micro-batch; without this the
    copies stay on the executors until a driver GC lets Spark's cleaner find
    them. Only use it around work whose DataFrames are not executed again.
    """
    prev = getattr(_TRACKING, "items", None)
    _TRACKING.items = []
    try:
        yield
    finally:
        for bc in _TRACKING.items:
            bc.unpersist(blocking=False)
        _TRACKING.items = prev


# --------------------------------------------------------------------------- catalogue preparation

def usable_vector(v: Column, dim: int) -> Column:
    """Present, of the right length, finite and not all zero."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & vector_dim_ok(v, dim) & finite & F.exists(v, lambda x: x != 0)


def usable_catalogue(catalogue: DataFrame, dim: int, id_col: str = "id",
                     vector_col: str = "embedding") -> DataFrame:
    """Catalogue rows that can be compared, equal vectors collapsed to their lowest id.

    Equal vectors tie for every news item and ties go to the lowest id, so the
    others can never be an answer; near-duplicate catalogues stay small.
    """
    v = F.col(vector_col)
    return (catalogue.where(usable_vector(v, dim)).groupBy(v.alias("embedding"))
            .agg(F.min(F.col(id_col).cast("long")).alias("id")).where(F.col("id").isNotNull())
            .select("id", "embedding"))


def catalogue_bytes(n_rows: int, dim: int) -> int:
    return n_rows * dim * 4 + n_rows * 8


# --------------------------------------------------------------------------- public operator

def nearest(left: DataFrame, catalogue: DataFrame, *, dim: int, vector: str = "embedding",
            cat_id: str = "id", cat_vector: str = "embedding",
            threshold: float | None = DEFAULT_THRESHOLD,
            strategy: str = "auto", max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
            nlist: int = DEFAULT_NLIST, nprobe: int = DEFAULT_NPROBE, seed: int = 7,
            block_rows: int = BLOCK_ROWS, cat_block_rows: int | None = None,
            prepared: PreparedCatalogue | None = None, rounds: int | None = None) -> DataFrame:
    """``left`` plus ``matched_market_id`` (long) and ``match_score`` (double).

    ``threshold`` is inclusive and applied after top-1; ``None`` keeps every
    top-1. ``left`` needs no key: the strategies that join their result back
    number its rows themselves. ``prepared`` (from ``prepare_catalogue`` on this
    same catalogue) reuses its size, broadcast matrix and inverted lists. ``rounds``
    bounds the rounds of ``ivf`` (None: until no list can hold a better match).
    """
    _one_blas_thread(left.sparkSession)
    if prepared is not None and strategy in ("auto", "broadcast") and prepared.bc is not None:
        return _threshold(_apply_broadcast(left, prepared.bc, dim, vector), threshold)
    if prepared is not None and strategy in ("auto", "bounded") and prepared.ivf is not None:
        return _threshold(_nearest_ivf(left, prepared.ivf, dim, vector, 1, block_rows, None if prepared.ivf.packed else cat_block_rows, None, threshold), threshold)
    if strategy == "ivf":
        index = prepared.ivf if prepared is not None and prepared.ivf is not None else prepare_lists(
            catalogue, dim, nlist, seed, cat_id, cat_vector)
        return _threshold(_nearest_ivf(left, index, dim, vector, nprobe, block_rows, cat_block_rows, rounds, threshold), threshold)
    # the size check, the collect or co-group and the list sizes each read the catalogue: it is written once
    cat = _written(usable_catalogue(catalogue, dim, cat_id, cat_vector))
    if strategy in ("auto", "broadcast"):
        n = cat.count() if prepared is None else prepared.n_rows      # ids only, before anything is collected
        fits = catalogue_bytes(n, dim) <= max_broadcast_bytes
        if n == 0:
            return _no_match(left)
        if strategy == "broadcast" and not fits:
            raise ValueError(f"catalogue of {n} rows x {dim} exceeds the broadcast budget; use strategy='blocked'")
        strategy = "broadcast" if fits else "bounded"
    if strategy == "broadcast":
        out = _apply_broadcast(left, _broadcast_matrix(left.sparkSession, cat.toArrow(), dim), dim, vector)
    elif strategy == "blocked":
        out = _nearest_blocked(left, cat, dim, vector, block_rows, cat_block_rows)
    elif strategy == "bounded":
        index = _block_lists(cat, dim, cat_block_rows, seed)
        if index is None:
            out = _nearest_blocked(left, cat, dim, vector, block_rows, cat_block_rows)
        else:
            out = _nearest_ivf(left, index, dim, vector, 1, block_rows, None, None, threshold)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return _threshold(out, threshold)


def _one_blas_thread(spark) -> None:
    """Every task's products run on one thread: Spark would give each worker as many as the executor has cores, and the tasks
    beside it already keep those busy (measured: 25 s of tasks with four threads each, 6 s with one)."""
    spark.sparkContext.environment.setdefault("OPENBLAS_NUM_THREADS", "1")


def _threshold(out: DataFrame, threshold: float | None) -> DataFrame:
    """Inclusive threshold applied after top-1: a best match below it becomes no match."""
    if threshold is None:
        return out
    keep = F.col("match_score") >= F.lit(float(threshold))
    return (out.withColumn("matched_market_id", F.when(keep, F.col("matched_market_id")))
               .withColumn("match_score", F.when(keep, F.col("match_score"))))


def _no_match(left: DataFrame) -> DataFrame:
    return (left.withColumn("matched_market_id", F.lit(None).cast("long"))
                .withColumn("match_score", F.lit(None).cast("double")))


def _broadcast_matrix(spark, tbl, dim: int):
    """Broadcast ``(token, ids ascending, float32 matrix)`` of a collected (size-checked) catalogue."""
    ids = tbl.column("id").to_numpy().astype(np.int64)
    flat = tbl.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    mat = np.asarray(flat, dtype=np.float32).reshape(len(ids), dim)
    order = np.argsort(ids, kind="stable")      # ascending ids: argmax then prefers the lowest id
    return _track(spark.sparkContext.broadcast((uuid.uuid4().hex, ids[order], mat[order])))


def _apply_broadcast(left: DataFrame, bc, dim: int, vector: str) -> DataFrame:
    m = _broadcast_udf(bc, dim)(F.col(vector))
    return (left.withColumn("_m", m)
                .withColumn("matched_market_id", F.col("_m.market_id"))
                .withColumn("match_score", F.col("_m.similarity"))
                .drop("_m"))


class PreparedCatalogue:
    """A catalogue measured once and, within the budget, broadcast (or cut into inverted lists) once.

    Reusable for as long as the catalogue it was made from does not change
    (a stream keeps one per catalogue version instead of collecting and
    broadcasting the matrix, or training the lists, again for every
    micro-batch). ``release()`` removes the executor copies.
    """

    def __init__(self, n_rows: int, text_bytes: int, bc=None, ivf=None, catalogue: DataFrame | None = None):
        self.n_rows, self.text_bytes, self.bc, self.ivf, self.catalogue = n_rows, text_bytes, bc, ivf, catalogue

    def release(self) -> None:
        for bc in (self.bc, self.ivf.bc if self.ivf is not None else None):
            if bc is not None:
                bc.unpersist(blocking=False)


def prepare_catalogue(catalogue: DataFrame, dim: int, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                      cat_id: str = "id", cat_vector: str = "embedding", strategy: str = "auto",
                      nlist: int = DEFAULT_NLIST, seed: int = 7) -> PreparedCatalogue:
    """Measure the usable catalogue; then broadcast it when it fits, or train its lists (``strategy="ivf"``, or beyond the budget).

    The catalogue is computed once, into the shared folder (``.catalogue``, from which ``enrich`` can read the texts).
    The number of rows is counted first, so a catalogue over the budget is never collected. The enrich text size is
    measured on slug and question alone.
    """
    catalogue = _written(catalogue)
    if strategy == "ivf":
        index = prepare_lists(catalogue, dim, nlist, seed, cat_id, cat_vector)
        return PreparedCatalogue(index.n_rows, _text_bytes(catalogue), None, index, catalogue)
    cat = usable_catalogue(catalogue, dim, cat_id, cat_vector)
    n = cat.count()
    bc = index = None
    if 0 < n and catalogue_bytes(n, dim) <= max_broadcast_bytes:
        bc = _broadcast_matrix(catalogue.sparkSession, cat.toArrow(), dim)
    elif n:
        index = _block_lists(_written(cat), dim, None, seed)
    return PreparedCatalogue(n, _text_bytes(catalogue), bc, index, catalogue)


def _text_bytes(catalogue: DataFrame) -> int:
    return int(catalogue.agg(F.coalesce(F.sum(F.octet_length("slug") + F.octet_length("question") + F.lit(32)),
                                        F.lit(0)).alias("b")).first()["b"])


# ----------------------------------------------------------- blocked co-group (exact beyond the bound, and IVF)

_BLOCK_OUT = "key long, market_id long, similarity double"


def _block_kernel(dim: int):
    """Best catalogue row of a co-group for each of its left rows, LEFT_BATCH_ROWS of them at a time."""
    def run(left_pdf: pd.DataFrame, cat_pdf: pd.DataFrame) -> pd.DataFrame:
        found = {"key": [], "market_id": [], "similarity": []}
        if len(left_pdf) and len(cat_pdf):
            ids = cat_pdf["id"].to_numpy(np.int64)
            order = np.argsort(ids, kind="stable")
            ids, raw = ids[order], np.stack(cat_pdf["embedding"].to_numpy()[order]).astype(np.float32, copy=False)
            inv = _reciprocal_norms(raw)
            keys, vectors = left_pdf["key"].to_numpy(np.int64), left_pdf["embedding"].to_numpy()
            for lo in range(0, len(keys), LEFT_BATCH_ROWS):
                x, ok = _stack(vectors[lo:lo + LEFT_BATCH_ROWS], dim)
                bi, bs = _best(x, ok, ids, raw, inv)
                sel = bi >= 0
                found["key"].append(keys[lo:lo + LEFT_BATCH_ROWS][sel])
                found["market_id"].append(ids[bi[sel]])
                found["similarity"].append(bs[sel])
        return pd.DataFrame({name: np.concatenate([np.zeros(0, kind), *found[name]]) for name, kind in
                             (("key", np.int64), ("market_id", np.int64), ("similarity", np.float64))})
    return run


def blocked_groups(left_kv: DataFrame, cat_kv: DataFrame, block_rows: int,
                   cat_block_rows: int | None = None) -> tuple[DataFrame, DataFrame] | None:
    """The two keyed sides of the blocked co-group, or None when no list has rows on both sides.

    Per list, the catalogue rows are split into ``B = ceil(n_cat / cat_block_rows)``
    blocks and the left rows into ``S`` salts; left rows are repeated over the
    B blocks and catalogue rows over the S salts, so every co-group
    ``(list_id, salt, block)`` holds at most about ``block_rows +
    cat_block_rows`` rows, no matter how hot a list is. The shuffle moves
    ``n_left x B + n_cat x S`` rows, so a list whose blocks do not fill the
    catalogue allowance gives the rest to its left side (fewer salts, fewer
    catalogue copies): ``S = ceil(n_left / (block_rows + cat_block_rows -
    ceil(n_cat / B)))``, raised where needed so that there are at least as many
    co-groups as task slots (each list gets its share by size). The per-list
    sizes have one row per list (bounded by ``nlist``); they are the only thing
    fetched to the driver.
    """
    cat_block_rows = cat_block_rows or CAT_BLOCK_ROWS
    slots = left_kv.sparkSession.sparkContext.defaultParallelism

    def blocks_and_salts(n_left: int, n_cat: int, left_total: int) -> tuple[int, int]:
        b = max(1, math.ceil(n_cat / cat_block_rows))
        left_rows = block_rows + cat_block_rows - math.ceil(n_cat / b)
        by_size = math.ceil(n_left / left_rows)
        by_slots = math.ceil(slots * n_left / max(1, left_total) / b)
        return b, max(1, by_size, min(by_slots, n_left))

    nl = left_kv.groupBy("list_id").agg(F.count(F.lit(1)).alias("n_left"))
    nc = cat_kv.groupBy("list_id").agg(F.count(F.lit(1)).alias("n_cat"))
    # one row per list present on both sides: bounded by nlist, so it is fetched and
    # shipped as two small map literals instead of being joined
    sizes = nl.join(nc, "list_id").collect()
    if not sizes:
        return None
    left_total = sum(int(r.n_left) for r in sizes)
    plan = {int(r.list_id): blocks_and_salts(int(r.n_left), int(r.n_cat), left_total) for r in sizes}
    s_map = F.create_map(*[F.lit(x) for lid, (_b, sl) in plan.items() for x in (lid, sl)])
    b_map = F.create_map(*[F.lit(x) for lid, (bl, _s) in plan.items() for x in (lid, bl)])
    S, B = F.element_at(s_map, F.col("list_id")), F.element_at(b_map, F.col("list_id"))
    ls = (left_kv.where(F.map_contains_key(s_map, F.col("list_id")))
          .withColumn("salt", F.pmod(F.xxhash64("key"), S).cast("int"))
          .withColumn("block", F.explode(F.sequence(F.lit(0), B - 1)))
          .select("list_id", "salt", "block", "key", "embedding"))
    cs = (cat_kv.where(F.map_contains_key(s_map, F.col("list_id")))
          .withColumn("block", F.pmod(F.xxhash64("id"), B).cast("int"))
          .withColumn("salt", F.explode(F.sequence(F.lit(0), S - 1)))
          .select("list_id", "salt", "block", "id", "embedding"))
    return ls, cs


def blocked_top1(left_kv: DataFrame, cat_kv: DataFrame, dim: int, block_rows: int,
                 cat_block_rows: int | None = None) -> DataFrame:
    """Top-1 per ``key`` of ``left_kv(key, list_id, embedding)`` against ``cat_kv(id, list_id, embedding)``.

    Co-groups are cut by ``blocked_groups``; each emits only the best
    catalogue row per left row of its block, and ``max_by`` (partially
    aggregated before its shuffle) merges the blocks of a key.
    """
    # the sizes pass and the main pass would each run the Python step that made the
    # vectors (embedding, list probing); it is written once to the shared folder instead
    left_kv = materialize_python(left_kv)
    sides = blocked_groups(left_kv, cat_kv, block_rows, cat_block_rows)
    if sides is None:
        return left_kv.sparkSession.createDataFrame([], _BLOCK_OUT)
    ls, cs = sides
    per_block = (ls.groupBy("list_id", "salt", "block")
                 .cogroup(cs.groupBy("list_id", "salt", "block"))
                 .applyInPandas(_block_kernel(dim), _BLOCK_OUT))
    return _best_of(per_block)


def _best_of(found: DataFrame) -> DataFrame:
    """The best (market_id, similarity) of each key; partially aggregated before the shuffle."""
    best = found.groupBy("key").agg(F.max_by(F.struct("market_id", "similarity"),
                                             F.struct(F.round("similarity", TIE_DECIMALS), -F.col("market_id"))).alias("b"))
    return best.select("key", F.col("b.market_id").alias("market_id"), F.col("b.similarity").alias("similarity"))


_ROW = "_match_row"


def _written(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder; what is made of it reads it from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _numbered(left: DataFrame) -> DataFrame:
    """``left`` with a row number that is written with the rows, so every later pass reads the same one.

    The caller's key may repeat or be of any type; the result is joined back on this number.
    """
    ensure_checkpoint_dir(left.sparkSession)
    return left.withColumn(_ROW, F.monotonically_increasing_id()).checkpoint(eager=True)


def _join_back(left: DataFrame, best: DataFrame) -> DataFrame:
    best = best.select(F.col("key").alias(_ROW), F.col("market_id").alias("matched_market_id"),
                       F.col("similarity").alias("match_score"))
    return left.join(best, _ROW, "left").drop(_ROW)


def _nearest_blocked(left, cat, dim, vector, block_rows, cat_block_rows=None):
    left = _numbered(left)
    lk = left.select(F.col(_ROW).alias("key"), F.lit(0).alias("list_id"),
                     F.col(vector).alias("embedding")).where(F.col("embedding").isNotNull())
    ck = cat.select("id", F.lit(0).alias("list_id"), "embedding")
    return _join_back(left, blocked_top1(lk, ck, dim, block_rows, cat_block_rows))


# --------------------------------------------------------------------------- IVF

def train_lists(cat: DataFrame, nlist: int, seed: int = 7):
    """k-means (cosine) over the usable catalogue, or a sample of about TRAIN_ROWS of it; returns the fitted model."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    n = cat.count()
    some = cat if n <= TRAIN_ROWS else cat.sample(TRAIN_ROWS / n, seed)
    feats = some.select("id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    km = KMeans(k=nlist, seed=seed, distanceMeasure="cosine", featuresCol="features", maxIter=20)
    return km.fit(feats)


def _probe_udf(bc, done: int, more: int, dim: int):
    """Arrow UDF (vector, best so far): the lists number ``done`` to ``done + more`` by falling bound that can reach the best.

    NULL for unusable vectors. Ties of the bound go to the lower list id. Of packed lists it is the packs, by their highest bound.
    """
    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def probe(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        cents, radii, starts = bc.value
        for vs, best in batches:
            x, ok = _stack_arrow(vs, dim)
            least = np.asarray(pc.fill_null(best.combine_chunks() if isinstance(best, pa.ChunkedArray) else best, -2.0)) - BOUND_SLACK
            bound = np.cos(np.maximum(0.0, np.arccos(np.clip(x @ cents.T, -1.0, 1.0)) - radii[None, :]))
            if starts is not None:
                bound = np.maximum.reduceat(bound, starts, axis=1)
            order = np.argsort(-bound, axis=1, kind="stable")[:, done:done + more]
            can = (np.take_along_axis(bound, order, 1) >= least[:, None]) & ok[:, None]
            offsets = np.zeros(len(ok) + 1, dtype=np.int32)
            offsets[1:] = np.cumsum(can.sum(axis=1))
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(order[can].astype(np.int32)), mask=pa.array(~ok))
    return probe


class InvertedLists:
    """Trained lists of one catalogue: broadcast (unit centroids, radii, starts), and its rows (id, list_id, embedding) written once.

    ``packed`` lists are searched several together: ``starts`` has the first list of every pack, ``n_lists`` counts the
    packs and ``list_id`` names them.
    """

    def __init__(self, rows: DataFrame | None, bc, n_rows: int, n_lists: int, packed: bool = False):
        self.rows, self.bc, self.n_rows, self.n_lists, self.packed = rows, bc, n_rows, n_lists, packed


def _angle_udf(bc, dim: int):
    @F.arrow_udf(T.DoubleType())
    def angle(vs: pa.Array, lists: pa.Array) -> pa.Array:
        x, _ = _stack_arrow(vs, dim)
        return pa.array(np.arccos(np.clip((x * bc.value[lists.to_numpy(zero_copy_only=False)]).sum(axis=1), -1.0, 1.0)))
    return angle


def prepare_lists(catalogue: DataFrame, dim: int, nlist: int = DEFAULT_NLIST, seed: int = 7,
                  cat_id: str = "id", cat_vector: str = "embedding") -> InvertedLists:
    """Train the inverted lists of a catalogue, assign its rows and measure the lists, once for any number of searches."""
    return _lists_of(_written(usable_catalogue(catalogue, dim, cat_id, cat_vector)), dim, nlist, seed)


def _lists_of(cat: DataFrame, dim: int, nlist: int, seed: int, pack_rows: int | None = None) -> InvertedLists:
    """The lists of a usable catalogue that is written already, packed to about ``pack_rows`` rows if given."""
    spark, n = cat.sparkSession, cat.count()
    if n == 0:
        return InvertedLists(None, None, 0, 0)
    model = train_lists(cat, max(1, min(nlist, n)), seed)            # no more lists than catalogue rows
    centers = np.asarray(model.clusterCenters(), dtype=np.float64)   # nlist x dim, bounded by nlist
    centers /= np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-300)
    from pyspark.ml.functions import array_to_vector
    assigned = model.transform(cat.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>"))))
    rows = _written(assigned.select("id", F.col("prediction").cast("int").alias("list_id"), "embedding"))
    held = spark.sparkContext.broadcast(centers)
    lists = rows.groupBy("list_id").agg(F.max(_angle_udf(held, dim)("embedding", "list_id")).alias("radius"),
                                        F.count(F.lit(1)).alias("n")).collect()
    radii = np.full(len(centers), -np.pi)                            # a list without rows bounds everything out
    for r in lists:
        radii[r.list_id] = r.radius
    held.unpersist(blocking=False)
    if pack_rows is None:
        return InvertedLists(rows, spark.sparkContext.broadcast((centers, radii, None)), n, len(centers))
    order, starts, pack_of = _packs(centers, {r.list_id: r.n for r in lists}, pack_rows)
    rows = rows.withColumn("list_id", F.get(F.lit([int(k) for k in pack_of]), F.col("list_id")))
    return InvertedLists(rows, spark.sparkContext.broadcast((centers[order], radii[order], starts)), n, len(starts), packed=True)


def _packs(centers: np.ndarray, sizes: dict[int, int], pack_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists side by side along the centroids' main axis, cut where the next would pass ``pack_rows``.

    Returns their order, the places where packs start, and every list's pack.
    """
    spread = centers - centers.mean(axis=0)
    order = np.argsort(spread @ np.linalg.svd(spread, full_matrices=False)[2][0], kind="stable")
    starts, filled, pack_of = [0], 0, np.zeros(len(centers), dtype=np.int64)
    for at, k in enumerate(order):
        if filled and filled + sizes.get(int(k), 0) > pack_rows:
            starts.append(at)
            filled = 0
        filled += sizes.get(int(k), 0)
        pack_of[k] = len(starts) - 1
    return order, np.array(starts), pack_of


def _block_lists(cat: DataFrame, dim: int, cat_block_rows: int | None, seed: int) -> InvertedLists | None:
    """About as many lists of a written catalogue as it fills blocks, packed to CAT_BLOCK_ROWS; None if that is one."""
    n_lists = min(MAX_LISTS, math.ceil(cat.count() / (cat_block_rows or CAT_BLOCK_ROWS)))
    return _lists_of(cat, dim, n_lists, seed, CAT_BLOCK_ROWS) if n_lists > 1 else None


def _nearest_ivf(left, index: InvertedLists, dim, vector, nprobe, block_rows, cat_block_rows=None, rounds=None, least=None):
    """Rounds over the lists: each visits, for every row that needs it, the next ones by their bound.

    Matches below ``least`` are not looked for: a list that cannot hold a better one is not visited even at first. Lists
    come by falling bound, so a row that visits none in the first round would visit none in a later one.
    """
    if not index.n_rows:
        return _no_match(left)
    # an embedding in the left plan runs once
    left = _numbered(left)
    lk = left.select(F.col(_ROW).alias("key"), F.col(vector).alias("embedding"))
    best, done, more = None, 0, max(1, nprobe)
    while done < index.n_lists and rounds != 0:
        known = lk.withColumn("similarity", F.lit(None).cast("double")) if best is None else lk.join(best.select("key", "similarity"), "key")
        bar = F.col("similarity") if least is None else F.greatest("similarity", F.lit(float(least)))
        probes = F.explode(_probe_udf(index.bc, done, more, dim)(F.col("embedding"), bar))
        todo = _written(known.withColumn("list_id", probes).select("key", "list_id", "embedding"))
        if todo.isEmpty():
            break
        found = blocked_top1(todo, index.rows, dim, block_rows, cat_block_rows)
        best = _written(found if best is None else _best_of(best.unionByName(found)))
        done, more = done + more, more * PROBE_GROWTH
        rounds = None if rounds is None else rounds - 1
    return _join_back(left, best) if best is not None else _no_match(left.drop(_ROW))


# --------------------------------------------------------------------------- catalogue views

def active_markets(markets: DataFrame) -> DataFrame:
    """Markets that can be matched: ``is_resolved = false`` (NULL is neither open nor resolved)."""
    return markets.where(F.col("is_resolved") == F.lit(False))


def market_vectors(markets: DataFrame, market_embeddings: DataFrame) -> DataFrame:
    """Inner equi-join of markets with their vectors (``m.id = me.market_id``)."""
    me = market_embeddings.select(F.col("market_id").alias("id"), "embedding")
    return markets.join(me, "id", "inner")


def match_catalogue(markets: DataFrame, market_embeddings: DataFrame) -> DataFrame:
    """Active markets with a vector: what the matcher searches."""
    return market_vectors(active_markets(markets), market_embeddings)


def enrich(matched: DataFrame, catalogue: DataFrame,
           max_broadcast_bytes: int = TEXT_BROADCAST_BYTES, text_bytes: int | None = None) -> DataFrame:
    """Attach slug and question of the matched market (left join keeps unmatched rows).

    Only the three narrow catalogue columns take part. They are broadcast when
    their measured size (``text_bytes``, or measured here) is under the
    budget, so the left side is never shuffled; otherwise Spark's shuffled
    join is used and no text passes through the driver.
    """
    m = catalogue.select(F.col("id").alias("matched_market_id"), F.col("slug").alias("matched_market"),
                         F.col("question").alias("matched_market_question"))
    if text_bytes is None:
        text_bytes = m.agg(F.coalesce(F.sum(F.octet_length("matched_market")
                                            + F.octet_length("matched_market_question") + F.lit(32)),
                                      F.lit(0)).alias("b")).first()["b"]
    cols = matched.columns + ["matched_market", "matched_market_question"]
    if text_bytes <= max_broadcast_bytes:
        return matched.join(F.broadcast(m), "matched_market_id", "left").select(*cols)
    # Shuffled join: unmatched rows (NULL key) and the news of a popular market would each hash to one
    # reducer. So the left side spreads every key over ENRICH_SALTS and the (one row per market)
    # catalogue is repeated for each salt; unmatched rows carry salts that no catalogue row has.
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(ENRICH_SALTS))
    left = (matched.withColumn("_ns", F.when(F.col("matched_market_id").isNull(), -1 - F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SALTS))).otherwise(salt))
            .withColumn("_jk", F.coalesce(F.col("matched_market_id"), F.lit(0).cast("long"))))
    right = (m.withColumn("_ns", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ENRICH_SALTS - 1).cast("long"))))
             .withColumnRenamed("matched_market_id", "_jk"))
    return left.join(right, ["_ns", "_jk"], "left").select(*cols)


# Ours: tasks that one market's news, and the unmatched news, spread over in the shuffled enrich.
ENRICH_SALTS = 16
NULL_SALTS = 1024
