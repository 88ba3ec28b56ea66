"""Properties of the matcher: every strategy gives the same answer, whatever the partitioning."""

import numpy as np
import pytest

from semjoin.operators import match as M

DIM = 8


def _frames(spark, seed, n_news=300, n_cat=120, dup=True):
    rng = np.random.default_rng(seed)
    cat = rng.normal(size=(n_cat, DIM)).astype(np.float32)
    if dup:
        cat[10] = cat[3]          # exact tie: the lower id must win
    news = rng.normal(size=(n_news, DIM)).astype(np.float32)
    news[:5] = cat[[3, 4, 5, 6, 7]]   # perfect matches
    ids = rng.permutation(np.arange(1000, 1000 + n_cat))
    c = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, cat)],
                              "id long, embedding array<float>")
    n = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(news)],
                              "news_id long, embedding array<float>")
    return n, c, ids, cat, news


def _brute(ids, cat, news):
    c64 = cat.astype(np.float64)
    cn = c64 / np.linalg.norm(c64, axis=1, keepdims=True)
    nn = news.astype(np.float64) / np.linalg.norm(news.astype(np.float64), axis=1, keepdims=True)
    s = nn @ cn.T
    out = {}
    for i, row in enumerate(s):
        r = np.round(row, M.TIE_DECIMALS)
        best = max(range(len(ids)), key=lambda j: (r[j], -ids[j]))
        out[i] = (int(ids[best]), row[best])
    return out


def _run(df):
    return {r.news_id: (r.matched_market_id, r.match_score) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_strategies_agree_with_brute_force(spark, seed):
    n, c, ids, cat, news = _frames(spark, seed)
    want = _brute(ids, cat, news)
    runs = {
        "broadcast": M.nearest(n, c, dim=DIM, threshold=None, strategy="broadcast"),
        "blocked": M.nearest(n, c, dim=DIM, threshold=None, strategy="blocked", block_rows=37,
                             cat_block_rows=29),
        "ivf_full": M.nearest(n, c, dim=DIM, threshold=None, strategy="ivf", nlist=6, nprobe=6, block_rows=50,
                              cat_block_rows=11),
    }
    for name, df in runs.items():
        got = _run(df)
        assert set(got) == set(want), name
        for k, (mid, sim) in want.items():
            assert got[k][0] == mid, (name, k)
            assert got[k][1] == pytest.approx(sim, abs=1e-9), (name, k)


def test_partitioning_does_not_change_matches(spark):
    n, c, *_ = _frames(spark, 3)
    a = _run(M.nearest(n.repartition(1), c, dim=DIM, threshold=0.2))
    b = _run(M.nearest(n.repartition(7), c.repartition(3), dim=DIM, threshold=0.2))
    assert a == b


def test_ivf_partial_probe_is_subset_quality(spark):
    n, c, ids, cat, news = _frames(spark, 4)
    got = _run(M.nearest(n, c, dim=DIM, threshold=None, strategy="ivf", nlist=6, nprobe=1))
    want = _brute(ids, cat, news)
    # approximate: a probed answer is never better than the exact one
    for k, (mid, sim) in got.items():
        if mid is not None:
            assert sim <= want[k][1] + 1e-9


def test_ivf_to_the_bound_is_exact_and_leaves_lists_out(spark, monkeypatch):
    """Clustered vectors: every answer is the exact one, and most lists are never visited."""
    rng = np.random.default_rng(21)
    centres = rng.normal(size=(40, DIM))
    cat = np.concatenate([c + rng.normal(scale=0.05, size=(30, DIM)) for c in centres]).astype(np.float32)
    news = np.concatenate([c + rng.normal(scale=0.05, size=(5, DIM)) for c in centres]).astype(np.float32)
    ids = np.arange(len(cat))
    c = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, cat)], "id long, embedding array<float>")
    n = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(news)] + [(9999, None)], "news_id long, embedding array<float>")
    visits, plain = [], M.blocked_top1

    def counting(todo, *args):
        visits.append(todo.count())
        return plain(todo, *args)
    monkeypatch.setattr(M, "blocked_top1", counting)
    got = _run(M.nearest(n, c, dim=DIM, threshold=None, strategy="ivf", nlist=40, nprobe=1))
    want = _brute(ids, cat, news)
    assert {k: v[0] for k, v in got.items() if k != 9999} == {k: v[0] for k, v in want.items()} and got[9999][0] is None
    assert visits[0] == len(news) and sum(visits) < 0.5 * 40 * len(news)
    first = _run(M.nearest(n, c, dim=DIM, threshold=None, strategy="ivf", nlist=40, nprobe=1, rounds=1))
    hit = np.mean([first[k][0] == want[k][0] for k in want])
    assert hit >= 0.9


def _shuffled_rows(monkeypatch):
    """Rows of both sides of every co-group, noted as they are made."""
    rows, plain = [], M.blocked_groups

    def counting(*args):
        sides = plain(*args)
        rows.append(sum(side.count() for side in sides or ()))
        return sides
    monkeypatch.setattr(M, "blocked_groups", counting)
    return rows


def test_bounds_keep_pairs_that_cannot_match_out_of_the_shuffle(spark, monkeypatch):
    """Same answers as all blocks against all; fewer rows shuffled, still fewer with a threshold, none where nothing can reach it."""
    rng = np.random.default_rng(22)
    centres = rng.normal(size=(30, DIM))
    cat = np.concatenate([c + rng.normal(scale=0.05, size=(20, DIM)) for c in centres]).astype(np.float32)
    news = np.concatenate([c + rng.normal(scale=0.4, size=(6, DIM)) for c in centres]
                          + [-centres, rng.normal(size=(60, DIM))]).astype(np.float32)          # many with no match near
    c = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(cat)], "id long, embedding array<float>")
    n = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(news)] + [(9999, None), (9998, [0.0] * DIM)],
                              "news_id long, embedding array<float>")
    rows = _shuffled_rows(monkeypatch)
    moved = {}
    for threshold in (None, 0.9):
        kw = dict(dim=DIM, threshold=threshold, cat_block_rows=20)
        want = _run(M.nearest(n, c, strategy="blocked", **kw))
        moved["blocked", threshold] = sum(rows)
        rows.clear()
        got = _run(M.nearest(n, c, strategy="bounded", **kw))
        moved["bounded", threshold] = sum(rows)
        rows.clear()
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
        assert sum(v[0] is not None for v in got.values()) > 100 and got[9999][0] is None and got[9998][0] is None
    assert moved["bounded", 0.9] < moved["bounded", None] < moved["blocked", None] == moved["blocked", 0.9]
    assert moved["bounded", 0.9] < 0.5 * moved["blocked", 0.9]
    opposite = n.where("news_id >= 180 AND news_id < 210")                  # no list can hold a match
    assert all(v[0] is None for v in _run(M.nearest(opposite, c, strategy="bounded", dim=DIM, threshold=0.999, cat_block_rows=20)).values())
    assert not rows


def test_small_lists_share_cogroups_and_do_not_multiply_the_shuffle(spark, monkeypatch):
    """Scattered vectors in lists of 8: rows go once to a co-group of lists, not once to each list; answers stay exact."""
    n, c, ids, cat, news = _frames(spark, 12, n_news=600, n_cat=400)
    want = _brute(ids, cat, news)
    rows = _shuffled_rows(monkeypatch)
    for block in (M.CAT_BLOCK_ROWS, 100):                                   # one pack, and four or more
        monkeypatch.setattr(M, "CAT_BLOCK_ROWS", block)
        rows.clear()
        got = _run(M.nearest(n, c, dim=DIM, threshold=0.1, strategy="bounded", cat_block_rows=8))
        assert {k: got[k][0] for k in want} == {k: v[0] if v[1] >= 0.1 else None for k, v in want.items()}
        copies = 1 if block > len(cat) else 8
        assert sum(rows) <= copies * len(news) + 8 * len(cat)               # in lists of 8 it was 50 lists a row, less some
    centers = np.eye(6)
    order, starts, pack_of = M._packs(centers, {0: 5, 1: 5, 2: 90, 4: 5, 5: 200}, 100)
    assert sorted(order) == list(range(6)) and starts[0] == 0
    size = np.zeros(len(starts))
    np.add.at(size, pack_of, [5, 5, 90, 0, 5, 200])
    assert size.max() == 200 and sum(size > 100) == 1                       # only a list that is larger by itself passes the size


def test_auto_beyond_the_budget_is_bounded_and_lists_are_kept(spark, monkeypatch):
    n, c, ids, cat, news = _frames(spark, 6)
    want = _brute(ids, cat, news)
    monkeypatch.setattr(M, "CAT_BLOCK_ROWS", max(1, len(ids) // 8))
    small = M.catalogue_bytes(2, DIM)
    trained, plain = [], M.train_lists
    monkeypatch.setattr(M, "train_lists", lambda *a: trained.append(1) or plain(*a))
    ready = M.prepare_catalogue(c.selectExpr("*", "'s' AS slug", "'q' AS question"), DIM, small)
    for _ in range(2):
        got = _run(M.nearest(n, c, dim=DIM, threshold=None, prepared=ready))
        assert {k: got[k][0] for k in want} == {k: v[0] for k, v in want.items()}
    assert len(trained) == 1 and ready.bc is None
    monkeypatch.setattr(M, "TRAIN_ROWS", 20)                                # trained on a sample: answers stay exact
    got = _run(M.nearest(n, c, dim=DIM, threshold=None, max_broadcast_bytes=small))
    assert {k: got[k][0] for k in want} == {k: v[0] for k, v in want.items()} and len(trained) == 2


def test_ivf_to_the_bound_on_scattered_vectors(spark):
    n, c, ids, cat, news = _frames(spark, 9)
    got = _run(M.nearest(n, c, dim=DIM, threshold=None, strategy="ivf", nlist=200))
    want = _brute(ids, cat, news)
    assert {k: got[k][0] for k in want} == {k: v[0] for k, v in want.items()}


def test_auto_switches_to_blocked_beyond_budget(spark):
    n, c, ids, cat, news = _frames(spark, 5)
    small_budget = M.catalogue_bytes(10, DIM)
    got = _run(M.nearest(n, c, dim=DIM, threshold=None, max_broadcast_bytes=small_budget, block_rows=40))
    want = _brute(ids, cat, news)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    with pytest.raises(ValueError):
        M.nearest(n, c, dim=DIM, strategy="broadcast", max_broadcast_bytes=small_budget)


def test_near_ties_resolved_exactly(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=DIM)
    cat = np.stack([base + rng.normal(scale=1e-6, size=DIM) for _ in range(40)]).astype(np.float32)
    news = np.stack([base + rng.normal(scale=1e-3, size=DIM) for _ in range(60)]).astype(np.float32)
    ids = np.arange(40)[::-1] + 100
    c = spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, cat)],
                              "id long, embedding array<float>")
    n = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(news)],
                              "news_id long, embedding array<float>")
    want = _brute(ids, cat, news)
    for strategy in ("broadcast", "blocked"):
        got = _run(M.nearest(n, c, dim=DIM, threshold=None, strategy=strategy, block_rows=16, cat_block_rows=7))
        assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}, strategy


def test_arrow_and_pandas_stacking_agree_on_edge_rows():
    import pyarrow as pa
    rows = [[1.0, 2.0, 2.0], None, [0.0, 0.0, 0.0], [1.0, 2.0], [float("nan"), 1.0, 1.0], [3.0, 0.0, 4.0],
            [1.0, None, 1.0]]
    arr = pa.array(rows, type=pa.list_(pa.float32()))
    xa, oka = M._stack_arrow(arr, 3)
    xp, okp = M._stack(np.array([None if r is None else np.array(r, dtype=np.float32) for r in rows],
                                dtype=object), 3)
    assert oka.tolist() == okp.tolist() == [True, False, False, False, False, True, False]
    assert np.allclose(xa, xp)


@pytest.mark.parametrize("strategy", ["blocked", "ivf"])
def test_python_vector_step_runs_once_per_row(spark, tmp_path, strategy):
    """The blocked and IVF paths read their left side several times; the embedding must not rerun."""
    import pandas as pd
    from pyspark.sql import functions as F
    from pyspark.sql import types as T
    marks = str(tmp_path)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def vec(ids: pd.Series) -> pd.Series:
        import os
        import uuid
        with open(os.path.join(marks, uuid.uuid4().hex), "w") as f:
            f.write(str(len(ids)))
        return pd.Series([np.random.default_rng(int(i)).normal(size=DIM).astype("float32") for i in ids])

    news = spark.range(0, 600, numPartitions=3).withColumnRenamed("id", "news_id") \
        .withColumn("embedding", vec(F.col("news_id")))
    _n, cat, *_ = _frames(spark, 3)
    kw = dict(nlist=3, nprobe=3) if strategy == "ivf" else {}
    out = M.nearest(news, cat, dim=DIM, threshold=None, strategy=strategy, block_rows=100, cat_block_rows=40, **kw)
    out.write.format("noop").mode("overwrite").save()
    evaluated = sum(int(p.read_text()) for p in tmp_path.iterdir())
    assert evaluated == 600
