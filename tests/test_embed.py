"""Embedders: hashing is deterministic and unit length; model batches are capped and failures become NULL."""

import numpy as np
from pyspark.sql import functions as F

from semjoin.operators import embed as EMB


def _texts(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")


def test_hash_embedder_unit_and_deterministic(spark):
    df = _texts(spark, ["Alpha beta beta", "alpha BETA beta", "---", "", None])
    got = {r.id: r.v for r in df.select("id", EMB.HashEmbedder(16)(F.col("text")).alias("v")).collect()}
    assert got[0] == got[1]                       # case-insensitive tokens
    assert abs(np.linalg.norm(np.array(got[0])) - 1) < 1e-6
    assert got[2] is None and got[3] is None and got[4] is None


def _loader():
    # built inside the test so the workers receive the function by value
    def load():
        import time as _time

        import numpy as _np

        def encode(texts):
            assert len(texts) <= 3, "request over the cap"
            if any("boom" in t for t in texts):
                raise RuntimeError("service error")
            if any("slow" in t for t in texts):
                _time.sleep(2)
            return _np.array([[float(len(t)), 1.0] for t in texts])
        return encode
    return load


def test_model_embedder_caps_batches_and_isolates_failures(spark):
    texts = ["a", "bb", "boom", "ccc", "", None, "dddd", "ee"]
    emb = EMB.ModelEmbedder(_loader(), dim=2, batch_size=3)
    got = {r.id: r.v for r in _texts(spark, texts).select("id", emb(F.col("text")).alias("v")).collect()}
    assert got[0] == [1.0, 1.0] and got[1] == [2.0, 1.0] and got[3] == [3.0, 1.0] and got[6] == [4.0, 1.0]
    assert got[2] is None and got[4] is None and got[5] is None


def test_model_embedder_timeout(spark):
    emb = EMB.ModelEmbedder(_loader(), dim=2, batch_size=3, timeout_s=0.5)
    got = {r.id: r.v for r in _texts(spark, ["ok", "slow one"]).select("id", emb(F.col("text")).alias("v")).collect()}
    assert got[0] == [2.0, 1.0] and got[1] is None


def test_model_loads_once_per_python_worker(spark):
    import uuid
    var = "SJ_TEST_MODEL_LOADS_" + uuid.uuid4().hex

    def load():
        import os
        n = int(os.environ.get(var, "0")) + 1
        os.environ[var] = str(n)
        pid = float(os.getpid())
        return lambda texts: [[float(n), pid] for _ in texts]

    emb = EMB.ModelEmbedder(load, dim=2, batch_size=10)
    texts = spark.range(0, 4000, numPartitions=16).select(F.col("id"), F.concat(F.lit("t"), F.col("id")).alias("text"))
    got = [r.v for r in texts.select(emb(F.col("text")).alias("v")).collect()]
    assert len(got) == 4000 and all(v is not None for v in got)
    # every vector was made by a worker that had loaded the model exactly once
    assert {v[0] for v in got} == {1.0}


def test_tokens_of_any_script(spark):
    texts = ["Zürich", "z rich", "привет мир", "ПРИВЕТ МИР", "日本 日本", "١٢", "... !"]
    got = [r.v for r in _texts(spark, texts).select("id", EMB.HashEmbedder(64)(F.col("text")).alias("v")).orderBy("id").collect()]
    assert got[0] != got[1] and got[2] == got[3] is not None and got[4] is not None and got[5] is not None and got[6] is None
    buckets = [r.b for r in _texts(spark, texts).select("id", EMB.token_buckets(F.col("text"), 64).alias("b")).orderBy("id").collect()]
    assert [sorted(set(b)) for b in buckets] == [[i for i, x in enumerate(v or []) if x > 0] for v in got]


def _slow_requests():
    def load():
        import time as _time

        def encode(texts):
            _time.sleep(3 if len(texts) > 1 else 60 if "hang" in texts[0] else 0.02)
            return [[float(len(t)), 1.0] for t in texts]
        return encode
    return load


def test_a_slow_request_costs_only_the_slow_text(spark):
    texts = [f"t{i}" for i in range(10)] + ["hang"] + [f"u{i}" for i in range(9)]
    emb = EMB.ModelEmbedder(_slow_requests(), dim=2, batch_size=10, timeout_s=0.3)
    got = {r.text: r.v for r in _texts(spark, texts).coalesce(1).select("text", emb(F.col("text")).alias("v")).collect()}
    assert [t for t, v in got.items() if v is None] == ["hang"]


def test_embed_batches_sends_real_requests(spark):
    def load():
        def encode(texts):
            if len(texts) > 7:
                raise ValueError("over the cap")
            return [None if t == "no" else [float(len(texts)), 0.0] for t in texts]
        return encode
    texts = ["no" if i % 10 == 3 else None if i % 10 == 4 else f"t{i}" for i in range(40)]
    got = sorted(tuple(r) for r in EMB.embed_batches(_texts(spark, texts).repartition(4), "text", "id", load, batch_size=7).collect())
    want = [(b, len(p), 2, sum(t not in (None, "no") for t in p)) for b in range(6) for p in [texts[7 * b:7 * b + 7]]]
    assert got == want
    assert EMB.embed_batches(_texts(spark, [None, ""]), "text", "id", load).collect()[0].dimension is None


def test_embedding_memory_does_not_grow_with_the_batch(monkeypatch):
    """A batch is tokenised in slices: same vectors, and a batch eight times as large needs hardly more memory."""
    import numpy as np
    import pyarrow as pa
    from semjoin.operators import embed as E
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 1 << 30, 200)) for _ in range(400)] + [None, "", "..", "x " * 9000]
    whole = pa.array(texts * 8, pa.string())
    monkeypatch.setattr(E, "SLICE_BYTES", 1 << 30)
    want = E._bucket_vectors(whole, 64, {}).to_pylist()
    monkeypatch.setattr(E, "SLICE_BYTES", 1 << 17)
    asked = []
    counts = E._bucket_counts
    monkeypatch.setattr(E, "_bucket_counts", lambda part, *a: asked.append(part.nbytes) or counts(part, *a))
    assert E._bucket_vectors(whole, 64, {}).to_pylist() == want and want[400] is None and want[402] is None
    assert max(asked) < 2 * (1 << 17) and len(asked) > 8
    assert E._bucket_vectors(pa.array([], pa.string()), 64, {}).to_pylist() == []
    cache = {}
    monkeypatch.setattr(E, "_TOKEN_CACHE_MAX", 1000)
    E._bucket_vectors(whole, 64, cache)
    assert len(cache) < 10_000                                     # the cap and a slice's tokens
