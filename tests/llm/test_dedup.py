"""Exact dedup and SimHash near-dedup: brute force, hot keys, nulls, repeated rows, clashing columns."""

import hashlib
import itertools
import random
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from semjoin.llm import common, simhash
from semjoin.llm.components import connected_components
from semjoin.llm.exact_dedup import DigestIndex

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 1, "clash", "clash") for i, t in rows], SCHEMA)


def brute_fp(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + width]), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, max_bits):
    """fp -> smallest fp reachable."""
    up = {f: f for f in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= max_bits:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    return {f: top(f) for f in fps}


def test_exact_batches(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (None, "a"), (None, "c"), (6, "é" * 70000)]
    index = DigestIndex(spark)
    got = index.add(frame(spark, rows), 1).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    for t, ids, keep in (("a", [1, 2, None], 2), ("", [3, 4], 4), ("b", [5, 5], 5), ("c", [None], None), ("é" * 70000, [6], 6)):
        g = by[hashlib.sha256(t.encode()).hexdigest()]
        assert sorted(map(str, (r.doc_id for r in g))) == sorted(map(str, ids))
        assert all(r.keep_id == keep and r.group_size == len(ids) for r in g)
        assert [r.doc_id for r in g if r.kept] == [keep]
    # later batch: what is known goes, whatever its id; a replay of the batch changes nothing
    for _ in range(2):
        more = {r.doc_id: r for r in index.add(frame(spark, [(9, "a"), (10, "z"), (0, "z")]), 2).collect()}
        assert (more[9].kept, more[9].keep_id) == (False, 2) and more[10].kept and not more[0].kept
        assert index.rows().count() == 6
    joined = index.rows().hint("merge").alias("x")
    plan = joined.join(index.rows().hint("merge").alias("y"), "text_sha256", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_exact_index_opens_again_with_its_own_buckets(spark):
    rows = [(i, f"t{i % 90}") for i in range(120)]
    path = DigestIndex(spark, buckets=5).path
    index = DigestIndex(spark, path)
    assert sum(r.kept for r in index.add(frame(spark, rows), 1).collect()) == 90
    spark.sql(f"DROP TABLE {index.table}")                    # as a later session, that has not declared the table
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = DigestIndex(spark, path)
        assert again.buckets == 5 and again.rows().count() == 90
        more = again.add(frame(spark, [(500, "t3"), (501, "new"), (502, "new")]), 2).collect()
        assert {r.doc_id: (r.keep_id, r.kept) for r in more} == {500: (max(i for i, t in rows if t == "t3"), False), 501: (502, False), 502: (502, True)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_exact_keep_new_and_empty(spark):
    docs = frame(spark, [(1, "a"), (2, "a"), (7, "b"), (7, "b"), (None, "c"), (None, "c"), (3, "A")])
    kept = DigestIndex(spark).keep_new(docs, 1)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("2", "a"), ("3", "A"), ("7", "b"), ("None", "c")]
    assert DigestIndex(spark).add(docs.limit(0), 1).count() == 0
    assert DigestIndex(spark).keep_new(docs.limit(0), 1).count() == 0


def test_join_counted_hot_and_light(spark):
    rows = spark.range(30000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"), "id")
    rows = common.stage(rows, "t")
    groups = common.stage(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low")), "t")
    out = common.join_counted(rows, groups, ["k"], "n", 30000)
    assert out.count() == 30000 and out.filter("k = 0 and low = 0").count() == 10000


def test_running_sum(spark):
    rng = random.Random(5)
    data = [("a" if i % 3 else None, i, rng.randrange(9)) for i in range(500)]
    df = spark.createDataFrame(data, "g string, i long, v long").withColumn("bin", F.floor(F.col("i") / 37))
    got = {r.i: r.s for r in common.running_sum(df, ["g"], "bin", [F.col("i")], F.col("v"), "s").collect()}
    seen = defaultdict(int)
    for g, i, v in data:
        assert got[i] == seen[g]
        seen[g] += v


@pytest.mark.parametrize("edges", [[(5, 4), (4, 3), (3, 2), (2, 1), (9, 8)], [(0, i) for i in range(1, 300)], [(i, i + 1) for i in range(120)], [(1, 1)], []])
def test_components(spark, edges):
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}
    for a, b in edges:
        up.setdefault(a, a), up.setdefault(b, b)
    for _ in up:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == {k: v for k, v in up.items() if any(a != b and k in (a, b) for a, b in edges)}


def test_fingerprint_chunks(monkeypatch):
    rng = random.Random(1)
    texts = [None, "", " \t\x0b", "One", "one TWO", "Été à la", "a b c", " ".join(rng.choice(["x", "Yé", "zz"]) for _ in range(500))]
    want = [brute_fp(t) for t in texts]
    assert [simhash.fingerprint_of(t, 3) for t in texts] == want
    monkeypatch.setattr(simhash, "WORDS_AT_ONCE", 7)
    assert [simhash.fingerprint_of(t, 3) for t in texts] == want


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
@pytest.mark.parametrize("cap", [2, 64])
def test_links_against_all_pairs(spark, max_bits, cap):
    rng = random.Random(max_bits)
    fps = {0, (1 << 64) - 1}
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(25):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    df = common.stage(spark.createDataFrame([(f,) for f in fps], "fp long"), "t")
    edges = [(r.a, r.b) for r in simhash.links(df, max_bits, cap).collect()]
    mask = (1 << 64) - 1
    want = brute_components([f & mask for f in fps], max_bits)
    up = {f: f for f in fps}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        up[top(a)] = top(b)
    got, exp = defaultdict(set), defaultdict(set)
    for f in fps:
        got[top(f)].add(f)
        exp[want[f & mask]].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, exp.values()))


def test_near_duplicates_whole(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(15):
        base = [rng.choice(words) for _ in range(rng.choice([5, 80, 600]))]
        for _ in range(12):
            t = list(base)
            for _ in range(rng.randrange(3)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((n, " ".join(t)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "X"), (n + 2, "X"), (None, "X"), (None, "only"), (n + 3, "w1 " * 30000)]
    rng.shuffle(rows)
    got = simhash.near_duplicates(frame(spark, rows), 3, 2, 4).collect()
    fps = {t: brute_fp(t) for _, t in rows}
    roots = brute_components(sorted(set(fps.values())), 2)
    low = defaultdict(list)
    for i, t in rows:
        low[roots[fps[t]]].append(i)
    want = sorted(str((i, f"{fps[t]:016x}", min([x for x in low[roots[fps[t]]] if x is not None], default=None))) for i, t in rows)
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want
    assert sum(r.stays for r in got) == len(low)
    docs = frame(spark, rows)
    kept = simhash.keep_one_of_each(docs, 3, 2, 4)
    assert kept.columns == docs.columns and kept.count() == len(low)
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0
