"""Periodic runs: all shifts by brute force, planted tails, nulls, long texts, repeated rows, clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np

from semjoin.llm import runs
from semjoin.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start long, period string"


def brute(words, least=12):
    """(start, length, period) of every run, by comparing the words with themselves shifted by every period."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q:
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in best.items() if e - s >= max(least, 2 * q)), key=lambda x: (x[0], x[2]))


def plain(i, text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode())
    n = len(words)
    code = None if i is None else zlib.crc32(str(i).encode())
    if code is not None and code % 10 == 0 and n:
        g = code // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    found = brute(words)
    gone = {k for s, m, q in found for k in range(s + q, s + m)}
    top = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
    return (i, len(found), *top, top[1] * 1000 // top[2] if found else None,
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in gone)).hexdigest())


def with_repeats(rng, n, k):
    ids = [rng.randrange(k) for _ in range(n)]
    for _ in range(rng.randrange(0, 4) if n > 14 else 0):
        a, e = rng.randrange(n - 2), rng.randrange(n)
        p = rng.randrange(1, max(2, (n - a) // 2))
        for i in range(a + p, e):
            ids[i] = ids[i - p]
    return ids


def test_against_all_shifts():
    rng, found = random.Random(1), 0
    for _ in range(3000):
        ids, least = with_repeats(rng, rng.randrange(0, 90), rng.choice([1, 2, 3, 8])), rng.choice([2, 3, 7, 12, 12])
        got = runs.find_runs(np.array(ids, dtype=np.int32), least)
        assert got == brute(ids, least)
        found += len(got)
    assert found > 3000


def test_many_periods_in_one_text():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    assert runs.find_runs(np.array(b, dtype=np.int32)) == brute(b)


def test_query_against_the_plain_definition(spark, tmp_path):
    rng, docs = random.Random(2), []
    for i in range(400):
        words = [f"w{x}" for x in with_repeats(rng, rng.choice([0, 5, 30, 120]), rng.choice([2, 9, 60]))]
        docs.append((i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(words)))
    docs += [(None, "a " * 30), (None, None), (901, ""), (902, " \n "), (903, "é " * 12), (903, "é " * 12), (904, "é " * 11), (905, " x " * 20)]
    docs += [(i, " ".join(f"v{x}" for x in range(100))) for i in range(1000, 1060)]          # nothing repeats but what the query plants
    spark.createDataFrame([(i, t, "en", "s", 1, 5, "clash") for i, t in docs], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted((plain(i, t) for i, t in docs), key=key)
    assert sum(r[1] > 0 for r in got if r[0] and r[0] >= 1000) >= 3


def test_a_very_long_text(spark):
    words = [f"x{i % 700}" for i in range(300_000)] + [f"y{i}" for i in range(50_000)] + ["z"] * 40
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    row = runs.text_runs(docs).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (2, 0, 300_000, 700, 428_571)
    kept = words[:700] + words[300_000:350_000] + ["z"]
    assert row.collapsed_sha256 == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_empty_table(spark):
    assert runs.text_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
