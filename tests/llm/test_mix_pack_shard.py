"""Mixing, packing and sharding: bounds and optimality by brute force, nulls, repeated rows, clashing columns."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from semjoin.llm import mixing, packing, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, slot string, row string, bucket string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, "x", "y", "z") for i, t, s in rows], SCHEMA)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.01, 100), min_size=1, max_size=30), st.integers(64, 600))
def test_schedule_deviation(weights, slots):
    counts = mixing.frame_counts(weights, slots)
    assert sum(counts) == slots and min(counts) >= 1
    seen = [0] * len(counts)
    for t, (lane, j, place) in enumerate(mixing.frame_schedule(counts)):
        assert place == t and j == seen[lane]
        assert j * slots // counts[lane] <= t < -(-(j + 1) * slots // counts[lane])
        seen[lane] += 1
        assert all(abs(k * slots - n * (t + 1)) < slots for k, n in zip(seen, counts))
    assert seen == counts


def test_frame_counts_proportion():
    assert mixing.frame_counts([1, 1, 2], 400) == [100, 100, 200]
    assert mixing.frame_counts([1e9] + [1e-9] * 5, 64) == [59, 1, 1, 1, 1, 1]
    with pytest.raises(ValueError):
        mixing.frame_counts([0.0, 1.0], 10)


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE_ROWS", 10)
    rng = random.Random(2)
    rows = [(i, "x" * rng.randrange(60), rng.choice(["a", "a", "a", "a", "b", "c", None, "rare1", "rare2"])) for i in range(600)]
    rows += [(1, None, "a"), (2, "", None), (3, "y" * 500, "b"), (3, "y" * 500, "b"), (None, "n", "b")]
    docs = frame(spark, rows)
    weights, rest = mixing.tempered_weights(docs, F.length("text"), max_lanes=5)
    assert len(weights) == 4 and "a" in weights and rest > 1
    got = mixing.scheduled(docs, F.length("text"), weights, rest, block_size=200, slots=64).collect()
    assert Counter((r.row.doc_id, r.row.text, r.source) for r in got) == Counter(rows)
    lanes, total = defaultdict(list), Counter()
    for r in got:
        lanes[r.lane].append(r)
    counts = mixing.frame_counts([*weights.values(), rest], 64)
    place = {(lane, j): p for lane, j, p in mixing.frame_schedule(counts)}
    for lane, own in lanes.items():
        own.sort(key=lambda r: (r.start, len(r.row.text or "")))
        at = 0
        for r in own:
            assert r.start == at and r.block == at // 200 and r.slot == r.block // counts[lane] * 64 + place[lane, r.block % counts[lane]]
            at += len(r.row.text or "")
        total[lane] = max(r.block for r in own) + 1
    # while no lane has run out, blocks delivered stay within one of the target
    slot_of = {(r.lane, r.block): r.slot for r in got}
    until = min((total[i] * 64) // counts[i] for i in lanes)
    for t in range(1, until):
        for i in lanes:
            begun = sum(1 for b in range(total[i]) if b // counts[i] * 64 + place[i, b % counts[i]] < t)
            assert abs(begun - counts[i] * t / 64) < 1
    assert slot_of
    ordered = mixing.in_mix_order(docs, F.length("text"), weights, rest, block_size=200, slots=64)
    assert ordered.columns == docs.columns and ordered.count() == len(rows)
    assert mixing.in_mix_order(docs.limit(0), F.length("text"), *mixing.tempered_weights(docs.limit(0), F.length("text"))).count() == 0


def brute_padding(lengths, buckets):
    values, best = sorted(set(lengths)), None
    for cut in itertools.combinations(values[:-1], min(buckets, len(values)) - 1):
        bounds = [*cut, values[-1]]
        pad = sum(next(b for b in bounds if b >= n) - n for n in lengths)
        best = pad if best is None else min(best, pad)
    return best


@pytest.mark.parametrize("seed", range(9))
def test_best_boundaries(seed):
    rng = random.Random(seed)
    lengths = [rng.randrange(14) * rng.randrange(1, 4) for _ in range(60)] if seed < 4 else [rng.choice([257, 300, 301, 302, *rng.sample(range(257, 5001), 6)]) for _ in range(60)]
    c = Counter(lengths)
    values = sorted(c)
    for k in (1, 2, 3, 4):
        bounds = packing.best_boundaries(values, [c[v] for v in values], k)
        assert bounds[-1] == max(lengths) and len(bounds) <= k
        assert sum(next(b for b in bounds if b >= x) - x for x in lengths) == brute_padding(lengths, k)


def test_boundaries_of_long_lengths_are_exact():
    assert packing.best_boundaries([300, 301], [1000, 10], 2) == [300, 301]
    lengths = list(range(257, 4000, 3))
    rng = random.Random(1)
    counts = [rng.randrange(1, 50) for _ in lengths]
    # plain dynamic programme over all cuts
    c, t = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(np.array(lengths) * counts)])
    best = np.where(np.arange(len(c)) == 0, 0.0, np.inf)
    for _ in range(6):
        best = np.array([0.0] + [min(best[:j] + lengths[j - 1] * (c[j] - c[:j]) - (t[j] - t[:j])) for j in range(1, len(c))])
    bounds = packing.best_boundaries(lengths, counts, 6)
    assert len(bounds) == 6 and sum((next(b for b in bounds if b >= x) - x) * k for x, k in zip(lengths, counts)) == best[-1]


def check_packed(rows, got, budget, n):
    assert Counter(r.doc_id for r in got) == Counter(i for i, _, _ in rows)
    batches = defaultdict(list)
    for r in got:
        assert r.n_words <= r.bucket_max
        batches[r.batch_id].append(r)
    assert sorted(batches) == list(range(len(batches)))
    open_batches = Counter()
    for b in batches.values():
        room = max(1, budget // max(1, b[0].bucket_max))
        assert {r.bucket for r in b} == {b[0].bucket} and sorted(r.position for r in b) == list(range(len(b))) and len(b) <= room
        open_batches[b[0].bucket] += len(b) < room
    assert max(open_batches.values()) <= 1 and len({r.bucket for r in got}) <= n


def test_packing(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(packing, "PIECE_ROWS", 10)
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randrange(40)), "a") for i in range(400)]
    rows += [(7, None, "a"), (8, "", None), (9, "w " * 9000, "b"), (10, "q w", "c"), (10, "q w", "c"), (None, " \t\n z", "c")]
    docs = frame(spark, rows)
    got = packing.pack(docs, packing.word_count(F.col("text")), 100, 5).collect()
    check_packed(rows, got, 100, 5)
    words = {i: len((t or "").split()) for i, t, _ in rows if i not in (7, 8, 9, 10)}
    assert all(r.n_words == words[r.doc_id] for r in got if r.doc_id in words)
    lengths = [r.n_words for r in got]
    assert sum(r.bucket_max - r.n_words for r in got) == brute_padding([x for x in lengths], 5)
    assert packing.pack(docs.limit(0), packing.word_count(F.col("text"))).count() == 0
    # batches fill in the order of the files
    docs.filter("doc_id IS NOT NULL").repartitionByRange(4, F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id")).write.parquet(str(tmp_path / "d"))
    again = packing.pack(spark.read.parquet(str(tmp_path / "d")), packing.word_count(F.col("text")), 100, 5, keep_file_order=True).collect()
    check_packed([r for r in rows if r[0] is not None], again, 100, 5)
    for b in {r.bucket for r in again}:
        ids = [r.doc_id for r in sorted((r for r in again if r.bucket == b), key=lambda r: (r.batch_id, r.position))]
        assert ids == sorted(ids, reverse=True)


def test_packing_keeps_an_order_beside_clashing_and_odd_columns(spark, tmp_path):
    rows = spark.range(40).selectExpr("40 - id AS doc_id", "repeat('w ', int(id % 3) + 1) AS text", "'mine' AS _metadata", "map('a', id) AS m", "parse_json('{}') AS v")
    rows.repartitionByRange(3, F.desc("doc_id")).sortWithinPartitions(F.desc("doc_id")).write.parquet(str(tmp_path / "d"))
    read = spark.read.parquet(str(tmp_path / "d"))
    words = packing.word_count(F.col("text"))
    for docs in (read, spark.createDataFrame(read.select("doc_id", "text").orderBy(F.desc("doc_id")).collect())):
        got = packing.pack(docs, words, 6, 1, keep_file_order=True).collect()
        assert [r.doc_id for r in sorted(got, key=lambda r: (r.batch_id, r.position))] == list(range(40, 0, -1))
    assert packing.pack(read, words, 6, 2).count() == 40
    weights = mixing.source_weights(read, F.length("text"), "_metadata")
    assert mixing.in_mix_order(read, F.length("text"), weights, source_col="_metadata").count() == 40


def brute_table(shards, size):
    orders = []
    for s in shards:
        import hashlib
        h = hashlib.md5(s.encode()).digest()
        a, b = int.from_bytes(h[:8], "big") % size, int.from_bytes(h[8:], "big") % (size - 1) + 1
        orders.append(iter([(a + b * j) % size for j in range(size)]))
    table = {}
    while len(table) < size:
        for i, order in enumerate(orders):
            if len(table) < size:
                table[next(x for x in order if x not in table)] = i
    return [table[i] for i in range(size)]


def test_sharding(spark, tmp_path):
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 251)
    assert table == brute_table(names, 251)
    sizes = Counter(table)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 251)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 251 / 3
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 251)
    with pytest.raises(ValueError):
        sharding.lookup_table(["a"], 250)
    rows = [(i if i % 3 else 0, "t", "s") for i in range(900)] + [(None, None, None), (5, "", ""), (5, "", "")]
    docs = frame(spark, rows)
    got = sharding.place(docs, F.col("doc_id"), names, 251).collect()
    assert Counter((r.row.doc_id, r.row.text) for r in got) == Counter((i, t) for i, t, _ in rows)
    assert all(r.shard == names[table[r.slot]] for r in got)
    assert len({r.shard for r in got}) == 7 and all(len({r.shard for r in got if r.row.doc_id == i}) == 1 for i in {r[0] for r in rows})
    assert sharding.place(docs.limit(0), F.col("doc_id"), names, 251).count() == 0
    sharding.write_shards(docs, F.col("doc_id"), names, str(tmp_path / "s"), 3, 251)
    sharding.write_shards(docs.limit(5).withColumn("shard", F.lit("mine")), F.col("doc_id"), names, str(tmp_path / "t"), 3, 251)
    assert {r.shard_in for r in spark.read.parquet(str(tmp_path / "t")).collect()} == {"mine"}
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == len(rows) and {r.shard for r in back.select("shard").distinct().collect()} == set(names)


def test_written_shards_spread_repeated_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    docs = spark.createDataFrame([(1, "same", {"k": 1})], "doc_id long, text string, extra map<string,int>").crossJoin(spark.range(4000).select()).unionByName(
        spark.range(400).selectExpr("id + 2 AS doc_id", "CAST(id AS STRING) AS text", "map('k', 2) AS extra"))
    sharding.write_shards(docs, F.col("doc_id"), ["a", "b"], path, files_per_shard=4)
    rows = spark.read.parquet(path).withColumn("file", F.input_file_name())
    assert rows.count() == 4400 and rows.where("doc_id = 1").select("shard").distinct().count() == 1
    copies = Counter(r.file for r in rows.where("doc_id = 1").select("file").collect())
    assert len(copies) >= 2 and max(copies.values()) <= 3000
