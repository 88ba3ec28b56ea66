"""Cross-polytope near-duplicates: all pairs by brute force, recall at the threshold, crowded buckets, copies, broken vectors."""

import numpy as np
import pytest

from semjoin.llm import crosspoly

SCHEMA = "vec_id long, embedding array<float>, label int, v string, cid long, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "clash", 7, "clash") for i, v in rows], SCHEMA).repartition(3)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, cosine=0.9):
    """(vec_id, n_links, component_id, kept) of each row, by comparing all pairs."""
    n, up = len(rows), list(range(len(rows)))
    vecs = [np.array([np.float32(x) for x in v], dtype=float) if usable(v) else None for _, v in rows]
    links = [0] * n

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for d in {len(v) for v in vecs if v is not None}:
        own = [i for i in range(n) if vecs[i] is not None and len(vecs[i]) == d]
        m = np.stack([vecs[i] for i in own])
        near = m @ m.T / np.outer(np.linalg.norm(m, axis=1), np.linalg.norm(m, axis=1)) >= cosine
        for a, b in zip(*np.nonzero(near)):
            if a != b:
                links[own[a]] += 1
                up[max(top(own[a]), top(own[b]))] = min(top(own[a]), top(own[b]))
    least = {}
    for i, (vid, _) in enumerate(rows):
        if vid is not None:
            least[top(i)] = min(vid, least.get(top(i), vid))
    return sorted(((vid, links[i], least.get(top(i)), vid == least.get(top(i))) for i, (vid, _) in enumerate(rows)), key=str)


def clusters(rng, sizes, dim, noise):
    """Vectors around random centres; of each centre's, cosines to it spread down with the noise."""
    out = []
    for size in sizes:
        c = rng.normal(size=dim)
        out += [c / np.linalg.norm(c) + noise * rng.normal(size=dim) / np.sqrt(dim) for _ in range(size)]
    order = rng.permutation(len(out))
    return [(int(i) * 3 + 1, out[i]) for i in order]


def found(spark, rows, **how):
    return sorted((tuple(r) for r in crosspoly.near_duplicates(frame(spark, rows), **how).collect()), key=str)


@pytest.mark.parametrize("dim,cell_rows", [(64, crosspoly.CELL_ROWS), (64, 16), (10, 16)])
def test_clear_clusters_against_all_pairs(spark, dim, cell_rows):
    rows = clusters(np.random.default_rng(dim), [1] * 60 + [2] * 20 + [70, 30], dim, 0.08)
    got = found(spark, rows, cell_rows=cell_rows)
    assert got == brute(rows) and max(r[1] for r in got) == 69


def test_every_pair_at_the_threshold_is_found_almost_always(spark):
    rng, n, dim, cosine = np.random.default_rng(3), 400, 64, 0.9
    rows = []
    for i in range(n):
        x, y = rng.normal(size=(2, dim))
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        c = cosine + 0.002
        rows += [(2 * i, x), (2 * i + 1, c * x + np.sqrt(1 - c * c) * y / np.linalg.norm(y))]
    want, got = brute(rows), found(spark, rows)
    assert sum(r[1] for r in want) == 2 * n
    assert 0.97 <= sum(r[1] for r in got) / sum(r[1] for r in want) <= 1      # recall, and no link below the threshold
    assert {r[0]: r[1] for r in got if r[1]}.items() <= {r[0]: r[1] for r in want}.items()


def test_spread_links_in_a_crowd(spark):
    rows = clusters(np.random.default_rng(4), [150, 1, 1, 40], 32, 0.45)         # cosines within a cluster lie around 0.83
    want = {r[0]: r[1] for r in brute(rows)}
    plain, cut = (found(spark, rows, cell_rows=c) for c in (crosspoly.CELL_ROWS, 16))
    assert plain == cut                                                           # a pair counts once, however it meets
    got = {r[0]: r[1] for r in plain}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.98 * sum(want.values()) > 100


def test_several_hashes_a_table():
    h = crosspoly.Hashing(32, 100_000_000, 0.9)
    assert h.hashes == 2 and 3 <= h.tables <= 20
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(1, keepdims=True) * x
    y = 0.9 * x + np.sqrt(0.19) * y / np.linalg.norm(y, axis=1, keepdims=True)
    a, b = (h.codes(z).reshape(len(z), h.tables, -1) for z in (x, y))
    met = ((a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)).any(1)
    assert met.mean() > 0.97
    assert (a[:, :, 0].max() < 64 ** 2) and all(len(set(row)) == crosspoly.PROBES for row in a[0].tolist())


def test_rotation_keeps_lengths_and_products():
    x = np.random.default_rng(6).normal(size=(5, 64))
    assert np.allclose(crosspoly.hadamard(x) @ crosspoly.hadamard(x).T, x @ x.T)


def test_broken_vectors_copies_and_nulls(spark):
    a, b = [1.0, 0.2, 0.0], [0.0, 0.0, 5.0]
    rows = [(5, a), (3, a), (3, a), (None, a), (None, None), (7, None), (8, [0.0, 0.0, 0.0]), (9, [1.0, None, 0.0]), (10, [float("nan")] * 3),
            (11, [float("inf"), 0.0, 0.0]), (12, b), (13, [-x for x in b]), (14, [3e38, 3e38 * 0.2, 0.0]), (15, [1e-38, 0.2e-38, 0.0]), (16, [1.0, 0.2]), (17, [1.0]),
            (None, [7.0]), (20, []), (21, [-0.0, 0.0, 2.0])]
    got = sorted((tuple(r) for r in crosspoly.near_duplicates(frame(spark, rows)).collect()), key=str)
    want = [(i, n, c, i == c) for i, n, c, _ in brute(rows)]
    assert [(i, n, c, k) for i, n, c, k in got] == want
    assert (14, 5, 3, False) in got and (12, 1, 12, True) in got and (8, 0, 8, True) in got


def test_a_third_of_all_rows_is_one_vector(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(400)] + [(1000 + i, rng.normal(size=4)) for i in range(5)] + [(2000, [1.0, 2.0, 3.0, 4.01])]
    got = {r[0]: r for r in found(spark, rows)}
    assert got[399][1:] == (400, 0, False) and got[0][1:] == (400, 0, True) and got[2000][1:] == (400, 0, False)


def test_empty_table(spark):
    assert crosspoly.near_duplicates(frame(spark, [])).collect() == []
