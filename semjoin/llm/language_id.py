"""Language identification by string kernels.

A text is the set of its character n-grams, n = 1 to MAX_N, over lower-cased words set apart by single spaces (hashed to
2 ** HASH_BITS). The blended-spectrum presence kernel of two texts is the number of n-grams they share over the root of
the product of their numbers of n-grams. Nystroem landmarks (training texts of every language) map a text to its kernel
values with them, and kernel ridge regression, one language against the rest, is fitted on that map. Texts are scored
in batches: presence matrix x landmark matrix gives the kernel values, times the coefficients gives a score a language.

Learning uses a bounded sample: ``max_train`` texts, as many of each language, but LEAST_EACH of each at least; they are
those with the smallest hash of their id. ``landmarks`` of them are landmarks, dealt over the languages, one of each at least. The
sample is made to n-gram sets on the executors, and only these reach the driver. Scoring uses every character of every text.

Defined cases: a null text or one without a letter is ``und`` with score 0; without training rows every text is ``und``
with score 0; texts equal in letters score alike; equal scores go to the language first in sorting order; null languages
and ids do not train; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semjoin.llm.common import stage

MAX_N = 4
HASH_BITS = 17
UND = "und"
CHARS_AT_ONCE = 1 << 20
ROWS_AT_ONCE = 128
#: Training texts of each language, if there are so many.
LEAST_EACH = 5
_LETTERS = regex.compile(r"\p{L}+")


def _mark_grams(text: str | None, seen: np.ndarray) -> bool:
    """Set ``seen`` at the hash of every n-gram of ``text``; whether it has a letter. Long texts go piece by piece."""
    text, at, tail, letters = (text or "").lower(), 0, " ", False
    while at < len(text):
        end = at + CHARS_AT_ONCE
        while end < len(text) and text[end - 1].isalpha():
            end += 1
        words = _LETTERS.findall(text, at, end)
        at = end
        if not words:
            continue
        letters = True
        run = tail + " ".join(words) + " "
        tail = run[-(MAX_N - 1):]
        code = np.frombuffer(run.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        h = np.zeros(len(code) + 1, dtype=np.uint64)
        for n in range(1, min(MAX_N, len(code)) + 1):
            h = h[:-1] * np.uint64(0x100000001B3) + code[n - 1:]
            mixed = (h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            seen[mixed >> np.uint64(64 - HASH_BITS)] = True
    return letters


def gram_sets(texts: pd.Series) -> Iterator[np.ndarray]:
    """The sorted hashed n-grams of each text."""
    seen = np.zeros(1 << HASH_BITS, dtype=bool)
    for t in texts:
        seen[:] = False
        _mark_grams(t, seen)
        yield np.flatnonzero(seen).astype(np.int32)


@dataclass
class KernelModel:
    languages: list[str]
    grams: np.ndarray       # the landmarks' n-grams, rising
    presence: np.ndarray    # landmarks x grams, uint8
    sizes: np.ndarray       # n-grams of each landmark
    coef: np.ndarray        # landmarks x languages
    bias: np.ndarray

    def predict(self, texts: pd.Series) -> pd.DataFrame:
        seen, marks = np.zeros(1 << HASH_BITS, dtype=bool), self.presence.astype(np.float32).T
        lang, best = [], []
        for at in range(0, len(texts), ROWS_AT_ONCE):
            part = texts.iloc[at:at + ROWS_AT_ONCE]
            x, size, letters = np.zeros((len(part), len(self.grams)), dtype=np.float32), np.ones(len(part)), []
            for i, t in enumerate(part):
                seen[:] = False
                letters.append(_mark_grams(t, seen))
                x[i], size[i] = seen[self.grams], max(1, np.count_nonzero(seen))
            kernel = (x @ marks) / np.sqrt(size[:, None] * self.sizes[None, :])
            margin = kernel @ self.coef + self.bias
            for i, ok in enumerate(letters):
                c = int(np.argmax(margin[i])) if ok and self.languages else -1
                lang.append(self.languages[c] if c >= 0 else UND)
                best.append(float(np.clip((margin[i, c] + 1) / 2, 0, 1)) if c >= 0 else 0.0)
        return pd.DataFrame({"lang_pred": lang, "score": best})


def fit(sets: list[np.ndarray], langs: list[str], landmarks: int = 96, ridge: float = 1e-3) -> KernelModel:
    """Nystroem map on landmarks dealt evenly over the languages (one of each at least), then ridge regression of +1 / -1 a language."""
    names = sorted(set(langs))
    if not names:
        return KernelModel([], np.zeros(0, dtype=np.int32), np.zeros((0, 0), dtype=np.uint8), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    of = {c: [i for i, x in enumerate(langs) if x == c] for c in names}
    turn = sorted((k, c, i) for c, own in of.items() for k, i in enumerate(own))
    marks = [i for _, _, i in turn[:max(landmarks, len(names))]]
    grams = np.unique(np.concatenate([sets[i] for i in marks]))
    presence = np.stack([np.isin(grams, sets[i], assume_unique=True) for i in marks]).astype(np.uint8)
    sizes = np.array([max(1, len(sets[i])) for i in marks], dtype=float)
    dense = presence.astype(np.float32)
    kernel = np.stack([dense @ np.isin(grams, s, assume_unique=True).astype(np.float32) for s in sets]) / np.sqrt(
        np.array([max(1, len(s)) for s in sets], dtype=float)[:, None] * sizes[None, :])
    value, vector = np.linalg.eigh(kernel[marks])
    good = value > 1e-8 * value.max()
    to_map = vector[:, good] / np.sqrt(value[good])
    phi = np.concatenate([kernel @ to_map, np.ones((len(sets), 1))], axis=1)
    target = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    penalty = ridge * len(sets) * np.eye(phi.shape[1])
    penalty[-1, -1] = 0.0
    w = np.linalg.solve(phi.T @ phi + penalty, phi.T @ target)
    return KernelModel(names, grams, presence, sizes, to_map @ w[:-1], w[-1])


def train(docs: DataFrame, chosen: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_train: int = 1000, landmarks: int = 96) -> KernelModel:
    """Fit on a bounded sample of the rows with a language for which ``chosen`` holds (an expression over ``docs``)."""
    rows = docs.filter(chosen).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "doc_id IS NOT NULL AND lang IS NOT NULL")
    counts = stage(rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("n")), "languages")
    quota = max(LEAST_EACH, -(-max_train // max(1, counts.count())))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)

    @F.pandas_udf("array<int>")
    def grams(texts: pd.Series) -> pd.Series:
        return pd.Series(list(gram_sets(texts)))

    # three times the quota is expected below this place, so the quota is there but for one case in 10 ** 9
    near = rows.join(counts, "lang").withColumn("at", place).filter(F.col("at") * F.col("n") < 3 * quota + 30)
    sets = near.groupBy("lang", "doc_id", "at").agg(F.min("text").alias("text")).select("lang", "doc_id", "at", grams("text").alias("grams"))
    first = Window.partitionBy("lang").orderBy("at", "doc_id")
    picked = stage(sets, "language_sets").withColumn("k", F.row_number().over(first)).filter(F.col("k") <= quota)
    got = stage(picked.select("lang", "doc_id", "grams"), "language_train").orderBy("lang", "doc_id").toPandas()
    return fit([np.asarray(g) for g in got["grams"]], list(got["lang"]), landmarks)


def predict(self, texts: pd.Series) -> pd.DataFrame:
        seen, marks = np.zeros(1 << HASH_BITS, dtype=bool), self.presence.astype(np.float32).T
        lang, best = [], []
        for at in range(0, len(texts), ROWS_AT_ONCE):
            part = texts.iloc[at:at + ROWS_AT_ONCE]
            x, size, letters = np.zeros((len(part), len(self.grams)), dtype=np.float32), np.ones(len(part)), []
            for i, t in enumerate(part):
                seen[:] = False
                letters.append(_mark_grams(t, seen))
                x[i], size[i] = seen[self.grams], max(1, np.count_nonzero(seen))
            kernel = (x @ marks) / np.sqrt(size[:, None] * self.sizes[None, :])
            margin = kernel @ self.coef + self.bias
            for i, ok in enumerate(letters):
                c = int(np.argmax(margin[i])) if ok and self.languages else -1
                lang.append(self.languages[c] if c >= 0 else UND)
                best.append(float(np.clip((margin[i, c] + 1) / 2, 0, 1)) if c >= 0 else 0.0)
        return pd.DataFrame({"lang_pred": lang, "score": best})


def fit(sets: list[np.ndarray], langs: list[str], landmarks: int = 96, ridge: float = 1e-3) -> KernelModel:
    """Nystroem map on landmarks dealt evenly over the languages (one of each at least), then ridge regression of +1 / -1 a language."""
    names = sorted(set(langs))
    if not names:
        return KernelModel([], np.zeros(0, dtype=np.int32), np.zeros((0, 0), dtype=np.uint8), np.zeros(0), np.zeros((0, 0)), np.zeros(0))
    of = {c: [i for i, x in enumerate(langs) if x == c] for c in names}
    turn = sorted((k, c, i) for c, own in of.items() for k, i in enumerate(own))
    marks = [i for _, _, i in turn[:max(landmarks, len(names))]]
    grams = np.unique(np.concatenate([sets[i] for i in marks]))
    presence = np.stack([np.isin(grams, sets[i], assume_unique=True) for i in marks]).astype(np.uint8)
    sizes = np.array([max(1, len(sets[i])) for i in marks], dtype=float)
    dense = presence.astype(np.float32)
    kernel = np.stack([dense @ np.isin(grams, s, assume_unique=True).astype(np.float32) for s in sets]) / np.sqrt(
        np.array([max(1, len(s)) for s in sets], dtype=float)[:, None] * sizes[None, :])
    value, vector = np.linalg.eigh(kernel[marks])
    good = value > 1e-8 * value.max()
    to_map = vector[:, good] / np.sqrt(value[good])
    phi = np.concatenate([kernel @ to_map, np.ones((len(sets), 1))], axis=1)
    target = np.where(np.array(langs)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    penalty = ridge * len(sets) * np.eye(phi.shape[1])
    penalty[-1, -1] = 0.0
    w = np.linalg.solve(phi.T @ phi + penalty, phi.T @ target)
    return KernelModel(names, grams, presence, sizes, to_map @ w[:-1], w[-1])


def train(docs: DataFrame, chosen: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          max_train: int = 1000, max_languages: int = 200, landmarks: int = 96) -> KernelModel:
    """Fit on a bounded sample of the rows with a language for which ``chosen`` holds (an expression over ``docs``)."""
    rows = docs.filter(chosen).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        "doc_id IS NOT NULL AND lang IS NOT NULL")
    counts = stage(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages), "languages")
    quota = max_train / max(1, counts.count())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)

    @F.pandas_udf("array<int>")
    def grams(texts: pd.Series) -> pd.Series:
        return pd.Series(list(gram_sets(texts)))

    picked = rows.join(F.broadcast(counts), "lang").withColumn("at", place * F.col("n")).filter(F.col("at") < quota)
    picked = picked.orderBy("at", "doc_id").limit(2 * max_train).select("lang", "doc_id", grams("text").alias("grams"))
    got = stage(picked, "language_train").orderBy("lang", "doc_id").toPandas()
    return fit([np.asarray(g) for g in got["grams"]], list(got["lang"]), landmarks)


def predict(text: Column, model: KernelModel) -> Column:
    """Struct (lang_pred, score) for a text."""
    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        return model.predict(texts)
    return of(text)
