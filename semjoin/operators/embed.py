"""Embedding step: text column -> ``array<float>`` column (NULL when the text cannot be embedded).

An embedder is any callable ``Column -> Column``. The offline default is a
feature-hashing embedder: tokens are runs of letters and digits of any script, ``md5(lower(token))``
bucket, L2-normalised counts. ``token_buckets`` states the rule as a JVM
expression; the embedder itself runs it in an Arrow UDF (tokenising in
Arrow's C++ kernels, distinct tokens hashed through a per-worker cache), which
measured 5x faster than the per-token JVM lambdas. A model-backed embedder
plugs in through ``ModelEmbedder``: an iterator Arrow UDF that loads the model
once per Python worker and embeds whole batches (cut to ``batch_size``), with
failures turned into NULL vectors.
"""

from __future__ import annotations

import hashlib
import queue
import threading
import uuid
from typing import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the hashing scheme (the SQL oracle repeats them).
TOKEN_PATTERN = r"[\p{L}\p{N}]+"
HASH_HEX_CHARS = 8
# Fixed value: most texts one embed request may carry.
MAX_BATCH_TEXTS = 100


def token_buckets(text: Column, dim: int) -> Column:
    """Bucket of every token: ``md5(lower(token))`` first 8 hex digits as an integer, modulo ``dim``."""
    toks = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)
    return F.transform(toks, lambda t: F.pmod(
        F.conv(F.substring(F.md5(F.lower(t)), 1, HASH_HEX_CHARS), 16, 10).cast("long"), F.lit(dim)).cast("int"))


# Ours: tokens whose buckets a worker remembers (some 15 MB).
_TOKEN_CACHE_MAX = 1 << 17
# Ours: bytes of text that are tokenised at a time. Tokens take some ten times the bytes of their text, so a worker
# needs the same memory whatever an Arrow batch holds; pieces of this size also stay near the processor's caches.
SLICE_BYTES = 1 << 21


# Fixed value derived from TOKEN_PATTERN: tokens are the non-empty pieces between its complement.
SPLIT_PATTERN = r"[^\p{L}\p{N}]+"


def _text_slices(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """``texts`` in order, in slices of about ``most`` bytes; a longer text is a slice of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield texts.slice(start, end - start)
        start = end


def _bucket_vectors(texts: pa.Array, dim: int, cache: dict) -> pa.Array:
    """Unit bag-of-buckets vectors (``list<float>``) of an Arrow string array; NULL without tokens.

    Tokenising, flattening and de-duplication run in Arrow's C++ kernels, over
    SLICE_BYTES of text at a time; only a slice's distinct tokens meet Python
    (a cache lookup, md5 on a miss); its counts are one ``np.bincount``.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    ok, values = np.zeros(n, dtype=bool), []
    at = 0
    for part in _text_slices(texts, SLICE_BYTES):
        m = _bucket_counts(part, dim, cache)
        norms = np.sqrt(np.einsum("ij,ij->i", m, m))
        some = norms > 0
        values.append((m[some] / norms[some, None]).astype(np.float32).ravel())
        ok[at:at + len(part)] = some
        at += len(part)
    pa.default_memory_pool().release_unused()       # what the tokens took: a worker is kept between tasks
    flat = np.concatenate(values) if values else np.zeros(0, dtype=np.float32)
    offsets = np.zeros(n + 1, dtype=np.int32)
    offsets[1:] = np.cumsum(np.where(ok, dim, 0))
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.float32()), mask=pa.array(~ok))


def _bucket_counts(texts: pa.Array, dim: int, cache: dict) -> np.ndarray:
    """Tokens of every text by bucket (texts x dim, float64)."""
    n = len(texts)
    pieces = pc.split_pattern_regex(texts, SPLIT_PATTERN)
    rows = pc.list_parent_indices(pieces)
    flat = pc.list_flatten(pieces)
    real = pc.greater(pc.binary_length(flat), 0)
    rows = rows.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    enc = pc.dictionary_encode(flat.filter(real))
    distinct = enc.dictionary.to_pylist()
    if len(cache) > _TOKEN_CACHE_MAX:
        cache.clear()
    per_token = np.empty(len(distinct), dtype=np.int64)
    for i, tok in enumerate(distinct):
        k = cache.get(tok)
        if k is None:
            k = int(hashlib.md5(tok.lower().encode()).hexdigest()[:HASH_HEX_CHARS], 16) % dim
            cache[tok] = k
        per_token[i] = k
    buckets = per_token[enc.indices.to_numpy(zero_copy_only=False)]
    return np.bincount(rows * dim + buckets, minlength=n * dim).reshape(n, dim).astype(np.float64)


def hash_encoder(dim: int) -> Callable[[list], list]:
    """The hashing embedder as a plain ``encode(texts)``: a vector per text, None for a text without tokens."""
    def encode(texts: list) -> list:
        return _bucket_vectors(pa.array(texts, pa.string()), dim, _bucket_cache(dim)).to_pylist()
    return encode


def _hash_vectors_udf(dim: int):
    """Arrow UDF: text -> unit bag-of-buckets vector (float32), NULL when the text has no token.

    Same rule as ``token_buckets``; tokens are hashed once per Python worker
    (a bounded token -> bucket cache), so repeated vocabulary costs a
    dictionary lookup.
    """
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def hash_vectors(texts: pa.Array) -> pa.Array:
        return _bucket_vectors(texts, dim, _bucket_cache(dim))
    # Marked non-deterministic only to stop Catalyst from inlining the call into
    # pushed-down filters (which would evaluate it twice); the result is deterministic.
    return hash_vectors.asNondeterministic()


# Per Python worker caches. UDF closures reach them only through the module-level functions
# below: those are pickled by reference, so every task in a reused worker finds the same dict
# (a closure naming the dict directly would ship an empty copy with every task).
_BUCKETS: dict = {}    # dim -> token -> bucket
_MODELS: dict = {}     # embedder token -> loaded encode function


def _bucket_cache(dim: int) -> dict:
    return _BUCKETS.setdefault(dim, {})


def _loaded_model(token: str, load: Callable[[], Callable[[list], np.ndarray]]):
    encode = _MODELS.get(token)
    if encode is None:
        while len(_MODELS) >= _MAX_MODELS:          # oldest first (dicts keep insertion order)
            _MODELS.pop(next(iter(_MODELS)))
        encode = _MODELS[token] = load()
    return encode


_MAX_MODELS = 2     # ours: models one Python worker keeps loaded


class HashEmbedder:
    """Deterministic bag-of-tokens embedder; a text without tokens gets NULL."""

    def __init__(self, dim: int = 64):
        self.dim = dim
        self._udf = _hash_vectors_udf(dim)

    def __call__(self, text: Column) -> Column:
        return F.when(text.isNotNull() & (F.length(text) >= 1), self._udf(text))


def _within(encode: Callable[[list], list], texts: list, limit: float | None):
    """``encode(texts)``; TimeoutError after ``limit`` seconds.

    Every limited request has a thread of its own, so a request that hangs
    holds up no other. ``encode`` must therefore bear a call while an earlier,
    abandoned one is still running.
    """
    if not limit:
        return encode(texts)
    done: queue.SimpleQueue = queue.SimpleQueue()

    def run() -> None:
        try:
            done.put((encode(texts), None))
        except BaseException as exc:  # noqa: BLE001 - handed to the caller
            done.put((None, exc))

    threading.Thread(target=run, daemon=True).start()
    try:
        out, exc = done.get(timeout=limit)
    except queue.Empty:
        raise TimeoutError(f"no answer within {limit} s") from None
    if exc is not None:
        raise exc
    return out


def request_vectors(encode: Callable[[list], list], texts: list, limit: float | None = None) -> list:
    """One request; if it fails or takes too long, each of its texts on its own. None for a text that fails."""
    def checked(part: list) -> list:
        got = [None if v is None else np.asarray(v, dtype=np.float32) for v in _within(encode, part, limit)]
        if len(got) != len(part):
            raise ValueError(f"{len(got)} vectors for {len(part)} texts")
        return got

    try:
        return checked(texts)
    except Exception:  # noqa: BLE001 - one bad request must not fail the job
        out = []
        for t in texts if len(texts) > 1 else []:
            try:
                out += checked([t])
            except Exception:  # noqa: BLE001
                out.append(None)
        return out or [None] * len(texts)


class ModelEmbedder:
    """Wrap ``encode(list[str]) -> vectors``, built once per worker by ``load()``.

    Requests carry at most ``batch_size`` texts. A request that fails or
    exceeds ``timeout_s`` is retried text by text (each with the same timeout,
    none waiting for another), and a text that still fails gets NULL, as an
    embedding service error would.
    """

    def __init__(self, load: Callable[[], Callable[[list], np.ndarray]], dim: int,
                 batch_size: int = MAX_BATCH_TEXTS, timeout_s: float | None = None):
        self.dim, self.batch_size = dim, batch_size
        load_fn, size, limit = load, batch_size, timeout_s
        token = uuid.uuid4().hex     # identifies this embedder's model in a reused Python worker

        @F.pandas_udf(T.ArrayType(T.FloatType()))
        def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            encode = _loaded_model(token, load_fn)
            for texts in batches:
                out = [None] * len(texts)
                asked = [(i, t) for i, t in enumerate(texts.tolist()) if t]
                for lo in range(0, len(asked), size):
                    chunk = asked[lo:lo + size]
                    for (i, _), v in zip(chunk, request_vectors(encode, [t for _, t in chunk], limit)):
                        out[i] = v
                yield pd.Series(out, dtype=object)
        # a model call can fail transiently: never duplicate or reorder it
        self._udf = embed.asNondeterministic()

    def __call__(self, text: Column) -> Column:
        return F.when(text.isNotNull() & (F.length(text) >= 1), self._udf(text))


def embed_batches(df: DataFrame, text_col: str, key_col: str, load: Callable[[], Callable[[list], list]],
                  batch_size: int = MAX_BATCH_TEXTS, timeout_s: float | None = None) -> DataFrame:
    """Batch requests: texts in key order, at most ``batch_size`` in a request, one row per request.

    ``load()`` gives the worker's ``encode``; each request calls it once with
    the non-empty texts of its batch. The row says how many texts the batch
    has (``count``), how long the vectors are (``dimension``) and how many
    texts got one (``embedded``). Rows are numbered in key order (a
    range-partitioned sort plus per-partition offsets, no global window); a
    batch is one bounded group.
    """
    from semjoin.operators.ids import with_dense_index
    token, size, limit = uuid.uuid4().hex, batch_size, timeout_s

    def send(batch: pd.DataFrame) -> pd.DataFrame:
        texts = [t for t in batch["text"].tolist() if t]
        vectors = request_vectors(_loaded_model(token, load), texts, limit) if texts else []
        real = [len(v) for v in vectors if v is not None]
        return pd.DataFrame({"batch": batch["batch"].iloc[:1], "count": [len(batch)], "dimension": [max(real, default=None)],
                             "embedded": [len(real)]}).astype({"dimension": "Int64"})

    ranked = with_dense_index(df.select(F.col(key_col).alias("key"), F.col(text_col).alias("text")).orderBy("key"), "rank")
    cut = ranked.select((F.col("rank") / F.lit(size)).cast("long").alias("batch"), "text")
    return cut.groupBy("batch").applyInPandas(send, "batch long, count long, dimension long, embedded long")
