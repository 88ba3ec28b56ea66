"""Toxicity, language identification (held-out accuracy, model against brute force) and the pipeline."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from semjoin.llm import language_id, packing, toxicity
from semjoin.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, folder, docs, labels):
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def toxic_corpus(seed, n=900):
    """Toxic exactly when an insult and a group meet; either alone is clean."""
    rng = random.Random(seed)
    plain, insults, groups = [f"w{a}{b}" for a in "abcdefgh" for b in "xyzuv"], ["fool", "scum"], ["northers", "southers"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.choice([8, 30, 200]))]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += [rng.choice(insults)] * insult + [rng.choice(groups)] * group
        rng.shuffle(words)
        docs.append((i, " ".join(w.replace("w", "W") for w in words) + ".", "en", "s", 1))
        labels.append((i, 1, int(insult and group)))
    return docs, labels


def test_fm_scores_are_the_pair_sums():
    rng = np.random.default_rng(1)
    terms = np.array(sorted(toxicity._hashed(w) for w in ("red", "green", "blue", "été")))
    model = toxicity.FM(0.3, terms, rng.normal(size=4), rng.normal(size=(4, toxicity.FACTORS)))
    texts = [None, "", "red", "Red, GREEN red", "blue red Été green", "none of them"]
    for t, s in zip(texts, model.scores(texts)):
        have = [int(np.searchsorted(terms, toxicity._hashed(w))) for w in {"red", "green", "blue", "été"} if w in (t or "").lower()]
        raw = 0.3 + sum(model.weight[i] for i in have) + sum(model.factor[i] @ model.factor[j] for i, j in itertools.combinations(have, 2))
        assert s == pytest.approx(1 / (1 + np.exp(-raw)))


def test_words_do_not_depend_on_the_pieces(monkeypatch):
    text = "Ab cd-éf 12 gh3ij " * 50 + "x" * 40
    whole = toxicity._words(text)
    seen = np.zeros(1 << language_id.HASH_BITS, dtype=bool)
    assert language_id._mark_grams(text, seen)
    monkeypatch.setattr(toxicity, "CHARS_AT_ONCE", 7)
    monkeypatch.setattr(language_id, "CHARS_AT_ONCE", 7)
    cut = np.zeros_like(seen)
    assert toxicity._words(text) == whole == {"ab", "cd", "éf", "gh", "ij", "x" * 40}
    assert language_id._mark_grams(text, cut) and (cut == seen).all()
    assert not language_id._mark_grams(" 12 ,", cut) and not language_id._mark_grams(None, cut)


def test_toxicity_learns_the_interaction(spark, tmp_path):
    docs, labels = toxic_corpus(1)
    y = {i: t for i, _, t in labels}
    docs += [(9000, None, None, None, None), (9001, "", "", "", 0), (None, "fool northers", "en", "s", 1), (9002, "Wax " * 50000 + "fool northers", "en", "s", 1), (5, docs[5][1], "en", "s", 1)]
    labels += [(None, 1, 1), (3, 1, None), (77777, 0, 1), (4, 1, y[4])]
    write(spark, tmp_path, docs, labels)
    got = QUERIES["op10_toxicity"](spark, str(tmp_path)).toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    held = got[got["held_out"] & got["doc_id"].isin(y)]
    assert len(held) > 100 and held["held_out"].equals(held["doc_id"].map(lambda i: zlib.crc32(str(int(i)).encode()) % 5 == 0))
    assert (held["predicted"] == held["doc_id"].map(y)).mean() > 0.97
    assert got[got["doc_id"] == 9002]["predicted"].item() == 1 and got[got["doc_id"] == 9000]["predicted"].item() == 0


def test_toxicity_without_labels(spark, tmp_path):
    docs, _ = toxic_corpus(2, 20)
    frame = spark.createDataFrame(docs, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.keep_clean(frame, toxicity.train(frame, none)).count() == 20
    assert toxicity.keep_clean(frame.limit(0), toxicity.train(frame.limit(0), none)).columns == frame.columns
    clean = spark.createDataFrame([(i, 0) for i in range(20)], "doc_id long, toxic int")
    assert toxicity.keep_clean(frame.withColumn("s", F.lit("x")).withColumn("row", F.lit(1)), toxicity.train(frame, clean)).count() == 20


def language_corpus(seed, n=600):
    rng = random.Random(seed)
    syllables = {"aa": ["the", "ing", "er"], "bb": ["que", "é", "eau"], "cc": ["sch", "ß", "ung"], "dd": ["ción", "ñ", "los"]}
    docs = []
    for i in range(n):
        lang = rng.choice("aa aa aa bb cc dd".split())
        text = " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.choice([2, 20, 300])))
        docs.append((i, text, lang, "s", 1))
    return docs


def test_language_id(spark, tmp_path):
    docs = language_corpus(3)
    extra = [(9000, None, "aa", "s", 0), (9001, "12 - ?", "bb", "s", 0), (9002, "the " * 300000, None, "s", 0), (None, "schung", "cc", "s", 0), (5, docs[5][1], docs[5][2], "s", 1)]
    write(spark, tmp_path, docs + extra, [])
    got = QUERIES["op6_language_id"](spark, str(tmp_path)).toPandas()
    assert len(got) == len(docs) + 5 and got["score"].between(0, 1).all()
    lang = {d[0]: d[2] for d in docs}
    held = got[got["held_out"] & got["doc_id"].isin(lang)]
    assert len(held) > 100 and (held["lang_pred"] == held["doc_id"].map(lang)).mean() > 0.97
    by = got.dropna(subset="doc_id").set_index("doc_id")["lang_pred"]
    assert by[9000] == by[9001] == "und" and by[9002] == "aa"
    empty = spark.createDataFrame([], SCHEMA)
    model = language_id.train(empty, F.lit(True))
    some = spark.createDataFrame(docs[:5], SCHEMA).select(language_id.predict(F.col("text"), model).alias("p"))
    assert [(r.p.lang_pred, r.p.score) for r in some.collect()] == [("und", 0.0)] * 5


def test_kernel_model_against_plain_kernels():
    """Batched scores equal kernel ridge regression on set intersections written out."""
    docs = language_corpus(5, 60)
    texts, langs = [d[1] for d in docs], [d[2] for d in docs]
    sets = list(language_id.gram_sets(pd.Series(texts)))
    model = language_id.fit(sets, langs, landmarks=len(docs), ridge=1e-3)
    own = [set(s.tolist()) for s in sets]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    marks = [i for _, _, i in sorted((k, c, i) for c in sorted(set(langs)) for k, i in enumerate(j for j, x in enumerate(langs) if x == c))]
    margin = np.array([[kernel(a, own[m]) for m in marks] for a in own]) @ model.coef + model.bias
    got = model.predict(pd.Series(texts))
    assert list(got["lang_pred"]) == [model.languages[i] for i in margin.argmax(1)]
    assert np.allclose(got["score"], np.clip((margin.max(1) + 1) / 2, 0, 1), atol=1e-3)


def brute_near(rows, width=3, bits=2):
    from tests.llm.test_dedup import brute_components, brute_fp
    fp = {i: brute_fp(t, width) for i, t in rows}
    root = brute_components(sorted(set(fp.values())), bits)
    low = {}
    for i in sorted(fp):
        low.setdefault(root[fp[i]], i)
    return set(low.values())


def test_pipeline(spark, tmp_path):
    docs, labels = toxic_corpus(7, 500)
    rng = random.Random(11)
    n = len(docs)
    docs = [(i, t, lang, rng.choice(["hot", "hot", "b", None]), len(t)) for i, t, lang, _, _ in docs]
    for j in range(120):                                     # copies and near copies
        base = docs[rng.randrange(60)][1].split()
        if j % 2:
            base[rng.randrange(len(base))] = "wax"
        docs.append((n + j, " ".join(base), "en", "hot", 1))
    docs += [(900, None, None, None, None), (901, "", "", "", 0), (902, "wax " * 30000, "en", "b", 1), (902, "wax " * 30000, "en", "b", 1)]
    write(spark, tmp_path, docs, labels)
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        made = step(spark, now, str(tmp_path))
        assert made.columns == now.columns or k == 4
        made.write.parquet(f"{tmp_path}/stage{k}")
        now = spark.read.parquet(f"{tmp_path}/stage{k}")
        kept.append([(r.doc_id, r.text) for r in now.collect()] if k < 4 else [(r.doc_id, None) for r in now.collect()])
    y = {i: t for i, _, t in labels}
    gone = {d[0] for d in docs} - {i for i, _ in kept[0]}
    assert sum(y.get(i, 1) for i in gone) / len(gone) > 0.9 and {900, 901, 902} <= {i for i, _ in kept[0]}
    best = {}
    for i, t in kept[0]:
        best[t or ""] = max(i, best.get(t or "", -1))
    assert Counter((i, t or "") for i, t in kept[1]) == Counter((i, t) for t, i in best.items())
    assert sorted(i for i, _ in kept[2]) == sorted(brute_near(kept[1]))
    assert Counter(kept[3]) == Counter(kept[2]) and sorted(i for i, _ in kept[4]) == sorted(i for i, _ in kept[3])
    assert sorted(out["doc_id"]) == sorted(i for i, _ in kept[4])
    # batches fill in the order of the mixing stage's files
    placed = packing.file_order(spark.read.parquet(f"{tmp_path}/stage3"), F.col("doc_id")).orderBy("part", "row")
    order = {r.doc_id: k for k, r in enumerate(placed.collect())}
    final = now.toPandas()
    for _, own in final.groupby("bucket"):
        places = [order[i] for i in own.sort_values(["batch_id", "position"])["doc_id"]]
        assert places == sorted(places)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    write(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
