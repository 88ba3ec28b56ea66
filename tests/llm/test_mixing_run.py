"""Mixing against the weights as given, over runs of many frames' length and with many sources."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from semjoin.llm import mixing


def docs_of(spark, sizes):
    rows = [(i, s, n) for i, (s, n) in enumerate((s, 1) for s, k in sizes for _ in range(k))]
    return spark.createDataFrame(rows, "doc_id long, source string, n long")


def most_off(slots_of, weights, until):
    """The largest deviation, in blocks, of any lane after any of the first ``until`` slots."""
    total, worst = sum(weights.values()), 0.0
    t = np.arange(1, until + 1)
    for lane, w in weights.items():
        had = np.searchsorted(np.sort(slots_of[lane]), t)
        worst = max(worst, np.abs(had - t * (w / total)).max())
    return worst


def test_deviation_from_the_given_weights_over_many_frames(spark):
    weights = {"a": 1.0, "b": 0.30001, "c": 1e-4}
    blocks = [76_920, 23_077, 7]
    docs = docs_of(spark, [(s, n) for s, n in zip(weights, blocks)])
    got = mixing.scheduled(docs, F.col("n"), dict(list(weights.items())[:2]), weights["c"], block_size=1).select("source", "slot").toPandas()
    slots_of = {s: own.to_numpy() for s, own in got.groupby("source")["slot"]}
    assert len(set(got["slot"])) == len(got) == sum(blocks)
    assert most_off(slots_of, weights, 90_000) < 1


def test_run_schedule_with_lanes_that_run_out():
    weights, blocks = [5.0, 1 / 3, 2.7, 1e-3], [40, 300, 0, 2]
    seen, share = Counter(), [w / sum(weights) for w in weights]
    last = -1
    for lane, j, t in mixing.run_schedule(weights, blocks):
        assert j == seen[lane] and t > last and int(j / share[lane]) <= t < -(-(j + 1) // share[lane])
        seen[lane] += 1
        last = t
    assert [seen[i] for i in range(4)] == blocks


def test_every_source_has_its_own_lane(spark):
    sizes = [(f"s{i}", 30) for i in range(400)] + [(None, 900)]
    docs = docs_of(spark, sizes)
    weights = mixing.source_weights(docs, F.col("n"))
    got = mixing.scheduled(docs, F.col("n"), weights, block_size=3).select("row.doc_id", "source", "lane", "slot").toPandas()
    assert sorted(got["doc_id"]) == list(range(docs.count())) and got["lane"].nunique() == 401
    got["source"] = got["source"].where(got["source"].notna(), None).fillna("-")
    shares = {"-": 30.0} | {s: 30 ** 0.5 for s, _ in sizes[:-1]}
    slots_of = {s: np.unique(own) for s, own in got.groupby("source")["slot"]}
    # until the first lane runs out
    assert most_off(slots_of, shares, int(10 * sum(shares.values()) / 30 ** 0.5)) < 1
    some, rest = mixing.tempered_weights(docs, F.col("n"), max_lanes=101)
    assert len(some) == 100 and abs(rest - 301 * 30 ** 0.5) < 1e-6
    empty = docs.limit(0)
    assert mixing.in_mix_order(empty, F.col("n"), mixing.source_weights(empty, F.col("n"))).count() == 0
