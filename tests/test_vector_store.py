"""Vectors stored by text: every distinct text is sent once over all runs; rows come out as they went in."""

import pytest
from pyspark.sql import functions as F

from semjoin.operators import embed as EMB
from semjoin.operators import vector_store as VS
from semjoin.session import shared_dir


def _counting(log):
    """A model that notes each text it is asked for in a file of its own worker."""
    def load():
        import os
        import uuid

        def encode(texts):
            with open(f"{log}/{os.getpid()}-{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(texts))
            if any(t == "fails" for t in texts):
                raise RuntimeError("service error")
            return [[float(len(t)), 1.0] for t in texts]
        return encode
    return EMB.ModelEmbedder(load, dim=2, batch_size=1)


def _asked(log):
    return sorted(p.read_text() for p in log.iterdir())


def test_each_distinct_text_is_sent_once_over_two_runs(spark, tmp_path):
    path, embedder = shared_dir(spark, "test-vectors"), _counting(str(tmp_path))
    first = ["a", "bb", "bb", "bb", "", None, "ccc"]
    second = ["bb", "dddd", "dddd", "a", None, "ccc", "Bb"]

    def run(texts):
        df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "id long, text string, digest string")
        got = VS.embed_stored(df, "text", embedder, path, "v", buckets=4)
        assert got.columns == ["id", "text", "digest", "v"]
        return {(r.id, r.text, r.digest, tuple(r.v) if r.v else None) for r in got.collect()}

    want = lambda texts: {(i, t, "x", (float(len(t)), 1.0) if t else None) for i, t in enumerate(texts)}
    assert run(first) == want(first) and _asked(tmp_path) == ["a", "bb", "ccc"]
    assert run(second) == want(second) and _asked(tmp_path) == ["Bb", "a", "bb", "ccc", "dddd"]
    assert run(second) == want(second) and len(_asked(tmp_path)) == 5
    VS.compact(spark, path, 4)
    assert VS.stored_vectors(spark, path).count() == 5
    assert run(first) == want(first) and len(_asked(tmp_path)) == 5


def test_a_text_that_got_no_vector_is_sent_again(spark, tmp_path):
    path, embedder = shared_dir(spark, "test-vectors-fail"), _counting(str(tmp_path))
    df = spark.createDataFrame([(1, "ok"), (2, "fails"), (3, "fails")], "id long, text string")
    for turn in (1, 2):
        got = {r.id: r.embedding for r in VS.embed_stored(df, "text", embedder, path, buckets=4).collect()}
        assert got == {1: [2.0, 1.0], 2: None, 3: None}
        assert _asked(tmp_path).count("ok") == 1 and _asked(tmp_path).count("fails") == turn


def test_empty_input_overlapping_runs_and_a_taken_name(spark, tmp_path):
    path, embedder = shared_dir(spark, "test-vectors-odd"), _counting(str(tmp_path))
    df = spark.createDataFrame([(1, "t"), (2, "t")], "id long, text string")
    assert VS.embed_stored(df.limit(0), "text", embedder, path, buckets=4).count() == 0
    assert VS.stored_vectors(spark, path).count() == 0
    VS.embed_stored(df, "text", embedder, path, buckets=4)
    # as two runs at once would leave it: the digest stands twice, and rows still come out once
    VS.keyed.append(VS.stored_vectors(spark, path), path, "digest", 4)
    assert VS.stored_vectors(spark, path).count() == 2
    assert VS.embed_stored(df, "text", embedder, path, buckets=4).count() == 2
    with pytest.raises(ValueError, match="already"):
        VS.embed_stored(df, "text", embedder, path, out_col="id")


def test_a_hot_text_is_stored_once(spark):
    path = shared_dir(spark, "test-vectors-hot")
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("the hot text")).otherwise(F.concat(F.lit("text "), F.col("id"))).alias("text"))
    got = VS.embed_stored(hot, "text", EMB.HashEmbedder(8), path)
    assert got.where("embedding IS NULL").count() == 0 and got.where("text = 'the hot text'").count() == 1000
    assert VS.stored_vectors(spark, path).count() == 2001
