"""Toxicity scores from a second-order factorization machine over hashed terms.

score = sigmoid(w0 + sum of w_i + sum over pairs of <v_i, v_j>), over the distinct terms of the whole text: its
lower-cased words and the beginnings of longer ones (so that forms of a word share terms), hashed to 2 ** HASH_BITS. The
pair part raises (or lowers) a text in which two terms meet, such as an insult and the mention of a group, where each
alone says little; sums of single weights cannot.

Learning: a bounded sample (``max_train`` labelled documents, those with the smallest hash of their id, of equal texts
one) is reduced on the executors to sets of hashed terms; one task fits the model and only the model reaches the driver.
Every term of MIN_DOCS texts or more takes part, whatever the labels. Weights are learned first (FTRL with an L1 penalty:
a weight stays zero until its gradients have added up to more than chance), then the factors, with steps in proportion
to a term's frequency up to FULL_RATE. How freely the factors move, GENTLE or FIRM, is chosen by the loss on a fifth
of the first sampled texts, CHOOSE_TERMS terms in all (``choose``). The sample of one task is also bounded by ``max_terms`` terms in all: texts
come in the order of their hash until these are reached. Scoring uses every word of every text. The model has
2 ** HASH_BITS terms at most, so sending it with the tasks is bounded.

Defined cases: null and empty texts have no term and score sigmoid(w0); a document with several labels is toxic if any
says so; null labels and null ids do not train; without labelled documents, or with one class only, the score is the
share of toxic labels (below 1e-8 if there is none); of equal training texts one counts; repeated rows score alike; an empty table
gives an empty result; extra columns are kept or ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semjoin.llm.common import stage, whole_row

HASH_BITS = 20
#: Beginnings of these many letters are terms, too.
PREFIXES = (4, 6)
FACTORS = 8
#: Texts of the sample that hold a term, at least.
MIN_DOCS = 2
#: Share of the texts from which on a term's factors start and move at full size.
FULL_RATE = 0.02
#: Texts scored at a time, which bounds memory.
TEXTS_AT_ONCE = 512
#: Steps that fit the weights at least, when the sample has few batches; terms (in all) of the sampled texts that choose
#: between the settings; and the share of the loss without any terms that GENTLE must leave for FIRM to be tried.
MIN_STEPS, CHOOSE_TERMS, WELL_LEARNED = 300, 2_500_000, 0.1
#: Characters of a text that are searched at a time.
CHARS_AT_ONCE = 1 << 20
_WORD = re.compile(r"[^\W\d_]+")


def _words(text: str | None) -> set[str]:
    """Distinct lower-cased words, found piece by piece (pieces end where a word does)."""
    out: set[str] = set()
    text, at = (text or "").lower(), 0
    while at < len(text):
        end = at + CHARS_AT_ONCE
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        out.update(_WORD.findall(text, at, end))
        at = end
    return out


def _hashed(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & ((1 << HASH_BITS) - 1)


def _terms(word: str) -> tuple[int, ...]:
    """The hashed terms of a word: itself and, if it is longer, its beginnings."""
    return (_hashed(word), *(_hashed(word[:n] + "*") for n in PREFIXES if len(word) > n))


@dataclass
class FM:
    bias: float
    terms: np.ndarray      # hashed terms, rising
    weight: np.ndarray     # one per term
    factor: np.ndarray     # terms x FACTORS

    def raw(self, row: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Scores before the sigmoid of n rows, given as (row, index into terms) pairs."""
        out = self.bias + np.bincount(row, self.weight[term], n)
        for v in self.factor.T:
            out += 0.5 * (np.bincount(row, v[term], n) ** 2 - np.bincount(row, v[term] ** 2, n))
        return out

    def scores(self, texts) -> np.ndarray:
        texts, raw, known = list(texts), [], {}
        index = np.full(1 << HASH_BITS, -1, dtype=np.int32)
        index[self.terms] = np.arange(len(self.terms), dtype=np.int32)
        for at in range(0, len(texts), TEXTS_AT_ONCE):
            raw.append(self._raw(texts[at:at + TEXTS_AT_ONCE], index, known))
        return 1 / (1 + np.exp(-np.clip(np.concatenate(raw or [np.zeros(0)]), -30, 30)))

    def _raw(self, texts: list, index: np.ndarray, known: dict[str, list[int]]) -> np.ndarray:
        row, term = [], []
        for k, text in enumerate(texts):
            found = set()
            for w in _words(text):
                own = known.get(w)
                if own is None:
                    own = known[w] = [i for i in index[list(_terms(w))].tolist() if i >= 0]
                found.update(own)
            row += [k] * len(found)
            term += found
            if len(known) > 500_000:
                known.clear()
        return self.raw(np.array(row, dtype=np.int64), np.array(term, dtype=np.int64), len(texts))


@dataclass(frozen=True)
class Setting:
    """How factors are learned: standard deviation of their start, rate, the least scale of a step's gradients, shrinking
    a step, bound on the sums that enter a gradient, whether the weights still move, and the least epochs and steps."""
    start: float
    rate: float
    scale: float
    decay: float
    bound: float
    weights_move: bool
    epochs: int
    steps: int


#: Factors that correct what the weights leave, and factors that may carry the whole answer.
GENTLE = Setting(0.02, 0.02, 3e-3, 1e-2, 1.0, False, 3, 100)
FIRM = Setting(0.05, 0.02, 1e-3, 1e-3, np.inf, True, 8, 300)


def _batches(row: np.ndarray, term: np.ndarray, n: int, batch: int, rng: np.random.Generator) -> list[tuple[np.ndarray, ...]]:
    """The n rows dealt at random into batches, each with what a step needs: its rows, of which ``some`` have terms; the
    terms of those, row after row from ``start`` on; and the distinct terms, whose rows ``of`` lists from ``first`` on."""
    order = np.argsort(row, kind="stable")
    term, begin = term[order].astype(np.int32), np.searchsorted(row[order], np.arange(n + 1))
    shuffled, out = rng.permutation(n), []
    for at in range(0, n, batch):
        pick = shuffled[at:at + batch]
        size = begin[pick + 1] - begin[pick]
        some = np.flatnonzero(size)
        t = np.concatenate([term[begin[r]:begin[r + 1]] for r in pick])
        by_term = np.argsort(t, kind="stable")
        distinct, first = np.unique(t[by_term], return_index=True)
        out.append((pick, some, t, (np.cumsum(size) - size)[some], np.repeat(np.arange(len(pick), dtype=np.int32), size)[by_term], distinct, first))
    return out


def fit_fm(row: np.ndarray, term: np.ndarray, label: np.ndarray, terms: np.ndarray, how: Setting = GENTLE, epochs: int = 12,
           batch: int = 256, rate: float = 1.0, l1: float = 40.0, positive: float = 4.0, seed: int = 7) -> FM:
    """Logistic loss on mini-batches of the rows; (row, index into terms) pairs, rows rising, list the terms present.

    First the weights, by FTRL (``rate``, ``l1``), then the factors, by Adam with ``how``; the weights in MIN_STEPS steps at least.
    A row of the rarer positive class counts up to ``positive`` times.
    """
    rng, n, m = np.random.default_rng(seed), len(label), len(terms)
    share = min(max(label.mean() if n else 0.0, 1e-9), 1 - 1e-9)
    if n == 0 or m == 0 or label.min() == label.max():
        return FM(float(np.log(share / (1 - share))), terms, np.zeros(m), np.zeros((m, FACTORS)))
    often = np.minimum(1.0, np.bincount(term, minlength=m) / (FULL_RATE * n)).astype(np.float32)
    p = rng.normal(0, how.start, (FACTORS, m)).astype(np.float32) * often
    mom, var, w, z, seen = np.zeros_like(p), np.zeros_like(p), np.zeros(m), np.zeros(m), np.zeros(m)
    bias, bias_seen, count = float(np.log(share / (1 - share))), 0.0, np.where(label > 0, max(1.0, min(positive, (1 - share) / share)), 1.0)
    dealt = _batches(row, term, n, batch, rng)
    first_part = max(epochs, -(-MIN_STEPS // len(dealt)))
    for epoch in range(first_part + max(how.epochs, -(-how.steps // len(dealt)))):
        pairs = epoch >= first_part
        for at in rng.permutation(len(dealt)):
            pick, some, t, start, of, distinct, first = dealt[at]
            s, raw = np.zeros((FACTORS, len(pick)), dtype=np.float32), np.full(len(pick), bias)
            if len(t):
                raw[some] += np.add.reduceat(w[t], start)
                if pairs:
                    own = p[:, t]
                    s[:, some] = np.add.reduceat(own, start, axis=1)
                    raw[some] += 0.5 * ((s[:, some] ** 2).sum(0) - np.add.reduceat((own ** 2).sum(0), start))
            err = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[pick]) * count[pick]
            bias_seen += err.sum() ** 2
            bias -= rate * 0.3 * err.sum() / (1 + np.sqrt(bias_seen))
            if not len(t):
                continue
            grad = np.add.reduceat(err[of], first)
            if not pairs or how.weights_move:
                now = seen[distinct] + grad ** 2
                z[distinct] += grad - (np.sqrt(now) - np.sqrt(seen[distinct])) / rate * w[distinct]
                seen[distinct] = now
                over = np.abs(z[distinct]) - l1
                w[distinct] = np.where(over > 0, -np.sign(z[distinct]) * over * rate / (1 + np.sqrt(now)), 0.0)
            if pairs:
                now = p[:, distinct]
                g = np.add.reduceat((np.clip(s, -how.bound, how.bound) * err.astype(np.float32))[:, of], first, axis=1)
                g = (g - grad.astype(np.float32) * np.clip(now, -how.bound, how.bound)) / np.float32(len(pick))
                m1 = mom[:, distinct] = 0.9 * mom[:, distinct] + 0.1 * g
                m2 = var[:, distinct] = 0.99 * var[:, distinct] + 0.01 * g ** 2
                p[:, distinct] = now * (1 - how.decay) - how.rate * often[distinct] * m1 / (np.sqrt(m2) + how.scale)
    return FM(bias, terms, w, p.T.astype(float))


def _fit(sets: list[np.ndarray], label: np.ndarray, how: Setting) -> FM:
    """The model over every term of ``sets`` that MIN_DOCS of them hold."""
    texts = np.zeros(1 << HASH_BITS, dtype=np.int32)
    for x in sets:
        texts[x] += 1
    terms = np.flatnonzero(texts >= MIN_DOCS)
    number = np.full(1 << HASH_BITS, -1, dtype=np.int32)
    number[terms] = np.arange(len(terms), dtype=np.int32)
    own = [(i := number[x])[i >= 0] for x in sets]
    row = np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in own])
    return fit_fm(row, np.concatenate([np.zeros(0, dtype=np.int32), *own]), label, terms, how)


def choose(sets: list[np.ndarray], label: np.ndarray) -> Setting:
    """The setting with the lesser loss on every fifth of the first texts, fitted on the others; these have CHOOSE_TERMS terms in all.

    FIRM is not tried where GENTLE has learned well: where it leaves less than WELL_LEARNED of the loss without any terms.
    """
    first = int(np.searchsorted(np.cumsum([len(x) for x in sets]), CHOOSE_TERMS, side="right"))
    sets, label = sets[:first], label[:first]
    held = np.arange(len(label)) % 5 == 0
    if len({*label[held]}) < 2 or len({*label[~held]}) < 2:
        return GENTLE
    share, loss = label[held].mean(), []
    for how in (GENTLE, FIRM):
        if loss and loss[0] < -WELL_LEARNED * (share * np.log(share) + (1 - share) * np.log(1 - share)):
            return GENTLE
        model = _fit([x for x, h in zip(sets, held) if not h], label[~held], how)
        index = np.full(1 << HASH_BITS, -1, dtype=np.int32)
        index[model.terms] = np.arange(len(model.terms), dtype=np.int32)
        own = [(i := index[x])[i >= 0] for x, h in zip(sets, held) if h]
        raw = model.raw(np.repeat(np.arange(len(own)), [len(x) for x in own]), np.concatenate(own), len(own))
        loss.append(np.logaddexp(0, np.where(label[held] > 0, -raw, raw)).mean())
    return GENTLE if loss[0] <= loss[1] else FIRM


def train(docs: DataFrame, labels: DataFrame, chosen: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_train: int = 20_000, max_terms: int = 30_000_000) -> FM:
    """Fit on the labelled documents for which ``chosen`` (over column doc_id of ``labels``) holds, at most ``max_train``."""
    marked = labels.select(F.col(id_col).alias("doc_id"), (F.col(label_col) > 0).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    marked = marked.filter(chosen if chosen is not None else F.lit(True)).groupBy("doc_id").agg(F.max("y").alias("y"))
    bounded = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)

    @F.pandas_udf("array<int>")
    def hashed_terms(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({x for w in _words(t) for x in _terms(w)}) for t in texts])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, sets, held = [], [], 0
        for batch in batches:
            for y, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                held += len(x.values)
                if held > max_terms:
                    break
                label.append(float(y))
                sets.append(x.values.to_numpy(zero_copy_only=False).astype(np.int32))
        label = np.array(label)
        model = _fit(sets, label, choose(sets, label))
        rows = np.column_stack([model.weight, model.factor]).astype(np.float32)
        rows = np.concatenate([np.full((1, 1 + FACTORS), model.bias, dtype=np.float32), rows])
        names = np.concatenate([[-1], model.terms]).astype(np.int32)
        for at in range(0, len(rows), 10_000):
            flat, k = pa.array(rows[at:at + 10_000].ravel()), len(rows[at:at + 10_000])
            yield pa.RecordBatch.from_arrays([pa.array(names[at:at + k]), pa.ListArray.from_arrays(np.arange(0, (k + 1) * (1 + FACTORS), 1 + FACTORS, dtype=np.int32), flat)],
                                             ["term", "p"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(bounded), "doc_id")
    sets = stage(texts.groupBy(F.xxhash64("text").alias("key")).agg(F.max(F.struct("y", "text")).alias("t"))
                 .select("key", "t.y", hashed_terms("t.text").alias("terms")), "toxicity_train")
    # one task, of at most max_train texts and max_terms terms
    fitted = stage(sets.repartition(1).sortWithinPartitions("key").select("y", "terms").mapInArrow(fit, "term int, p array<float>"), "toxicity_model")
    got = fitted.orderBy("term").toArrow()
    if not got.num_rows:
        return fit_fm(*[np.zeros(0, dtype=np.int32)] * 2, np.zeros(0), np.zeros(0, dtype=np.int32))
    p = got["p"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(got.num_rows, 1 + FACTORS)
    return FM(float(p[0, 0]), got["term"].to_numpy()[1:], p[1:, 0], p[1:, 1:])


def score(text: Column, model: FM) -> Column:
    """Score from 0 to 1 of a text; the likelier toxic the higher."""
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts))
    return of(text)


def keep_clean(docs: DataFrame, model: FM, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, whose score is below 0.5."""
    return docs.select(whole_row(docs), score(F.col(text_col), model).alias("s")).filter("s < 0.5").select("row.*")
