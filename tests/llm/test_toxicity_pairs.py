"""Toxicity where no term tells anything alone, only the meeting of two does."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from semjoin.llm import toxicity


def letters(n):
    return "".join(chr(97 + int(c)) for c in str(n))


def rare_pairs(seed, n, kinds, noise):
    """Toxic exactly when an insult and a group both occur or both don't; ``kinds`` words of each, so that a pair is rare."""
    rng, docs = random.Random(seed), []
    for i in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [f"x{letters(rng.randrange(noise))}" for _ in range(rng.choice([8, 30]))]
        words += [f"i{letters(rng.randrange(kinds))}"] * insult + [f"g{letters(rng.randrange(kinds))}"] * group
        rng.shuffle(words)
        docs.append((i, " ".join(words), int(insult == group)))
    return docs


@pytest.mark.parametrize("n,kinds", [(1600, 1), (16000, 30)])
def test_terms_that_tell_nothing_alone(spark, n, kinds):
    docs = rare_pairs(4, n, kinds, 60)
    y = {i: t for i, _, t in docs}
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    model = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.col("doc_id") % 16 < 12)
    held = frame.filter("doc_id % 16 >= 12").select("doc_id", toxicity.score(F.col("text"), model).alias("s")).collect()
    assert len(held) == n // 4 and np.mean([(r.s >= 0.5) == y[r.doc_id] for r in held]) > 0.95


def sets_of(docs):
    return [np.array(sorted({x for w in toxicity._words(t) for x in toxicity._terms(w)}), dtype=np.int32) for _, t, _ in docs], np.array([float(y) for _, _, y in docs])


def test_factors_move_freely_only_where_they_are_needed():
    assert toxicity.choose(*sets_of(rare_pairs(5, 4000, 5, 60))) is toxicity.FIRM
    rng = random.Random(6)
    plain = [(i, " ".join(f"x{letters(rng.randrange(3000))}" for _ in range(200)) + " scum" * (i % 10 == 0), int(i % 10 == 0)) for i in range(2000)]
    sets, label = sets_of(plain)
    assert toxicity.choose(sets, label) is toxicity.GENTLE
    model = toxicity._fit(sets, label, toxicity.GENTLE)
    got = model.scores([t for _, t, _ in plain]) >= 0.5
    assert (got == (label > 0)).all()
    # the telling term stands out from the thousands of others, most of which stay at zero
    own = int(np.searchsorted(model.terms, toxicity._hashed("scum")))
    assert model.weight[own] > 2 * np.abs(np.delete(model.weight, own)).max() and (model.weight != 0).mean() < 0.5


def test_sample_is_bounded_by_terms(spark):
    docs = rare_pairs(7, 400, 2, 60)
    frame = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    small = toxicity.train(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), max_terms=500)
    assert 0 < len(small.terms) < 70
