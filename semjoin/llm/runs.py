"""Periodic runs of words: every maximal repetition within a text, found with a suffix automaton and link-cut access.

A run is a stretch of consecutive words with smallest period q, at least ``max(least, 2 q)`` long, that no neighbouring
word extends. The automaton of the words read so far has a state for each set of end positions; its suffix links form a
tree, in which the states from the newest one up to the root are the suffixes of what was read, and every state has a
colour, the last place where its words ended. Appending a word at r recolours that path with r. The tree is kept as a
link-cut forest whose preferred paths are each of one colour, so ``access`` meets the path in few segments: a segment of
colour e that reaches down to length m says that r and e have a common past of exactly m words. With q = r - e <= m this
is a square of period q that ends at r, and the run that it belongs to began at e - m + 1. Its end is the last r that
says so. No other period can be reported: a shorter period of the same stretch would have left a later colour.

Automata are only built where a run can be: with ``least`` words or more and two periods, a run agrees with itself,
shifted, over ``ceil(least / 2)`` words at least, so each of its words lies in a sequence of so many words that the text
holds twice. Hashes of these sequences are compared first (equal hashes of different sequences only cost time), and each
stretch of words so covered gets an automaton of its own. All work on one text is in the order of its words times the
logarithm; memory is in proportion to the longest such stretch.

Defined cases: a null text has no words; empty texts and texts shorter than ``least`` have no runs; null ids count like
any others and are never changed; repeated rows are each reported; an empty table gives an empty result; extra columns are
ignored. Words are compared as bytes.
"""

from __future__ import annotations

import hashlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that a run has at least.
LEAST = 12


class LastEnds:
    """A suffix automaton of what was appended, whose suffix-link tree answers where the current suffixes ended before."""

    def __init__(self, most: int):
        size = 2 * most + 3
        # a state's suffix link, length, and first transition; further transitions in ``more``. State 0 is none, 1 the root.
        self.link, self.length = array("i", bytes(4 * size)), array("i", bytes(4 * size))
        self.word, self.to = array("i", [-1]) * size, array("i", bytes(4 * size))
        self.more: dict[int, dict[int, int]] = {}
        # the link-cut forest: splay children (shallower, deeper), parent or path parent, colour (at the root of a splay tree)
        self.left, self.right = array("i", bytes(4 * size)), array("i", bytes(4 * size))
        self.up, self.colour = array("i", bytes(4 * size)), array("i", [-1]) * size
        self.states, self.last, self.at = 1, 1, 0

    def _splay(self, x: int) -> None:
        left, right, up, colour = self.left, self.right, self.up, self.colour
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                colour[x] = colour[z]                    # the last one so taken is the splay tree's
                self._rotate(y if (left[z] == y) == (left[y] == x) else x)
            else:
                colour[x] = colour[y]
            self._rotate(x)
            y = up[x]

    def _rotate(self, x: int) -> None:
        left, right, up = self.left, self.right, self.up
        y = up[x]
        z = up[y]
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y], up[x] = x, z

    def _next(self, s: int, w: int) -> int:
        if self.word[s] == w:
            return self.to[s]
        more = self.more.get(s)
        return more.get(w, 0) if more else 0

    def append(self, w: int) -> list[tuple[int, int]]:
        """Read word ``w``; (earlier end, length of the common past) for each earlier place where a suffix ended last."""
        link, length, word, to = self.link, self.length, self.word, self.to
        now, p, r = self.states + 1, self.last, self.at
        self.states, self.last, self.at = now, now, r + 1
        length[now] = r + 1
        while p:
            if word[p] < 0:
                word[p], to[p] = w, now
            elif word[p] == w or w in self.more.get(p, ()):
                break
            else:
                self.more.setdefault(p, {})[w] = now
            p = link[p]
        if not p:
            link[now] = 1
        else:
            q = self._next(p, w)
            if length[q] == length[p] + 1:
                link[now] = q
            else:
                link[now] = self._split(p, q, w)
        self.up[now] = link[now]
        return self._access(now, r)

    def _split(self, p: int, q: int, w: int) -> int:
        """The clone of q for the words up to those that p and w give; it goes right above q, on the same preferred path."""
        link, word, to = self.link, self.word, self.to
        c = self.states = self.states + 1
        self.length[c] = self.length[p] + 1
        word[c], to[c], link[c] = word[q], to[q], link[q]
        if q in self.more:
            self.more[c] = dict(self.more[q])
        while p and self._next(p, w) == q:
            if word[p] == w:
                to[p] = c
            else:
                self.more[p][w] = c
            p = link[p]
        link[q] = c
        self._splay(q)
        above = self.left[q]
        self.left[c], self.left[q], self.up[c] = above, c, q
        if above:
            self.up[above] = c
        return c

    def _access(self, x: int, r: int) -> list[tuple[int, int]]:
        """Give the path from the root to ``x`` the colour r; what colours it had, from below."""
        left, right, up, colour, length = self.left, self.right, self.up, self.colour, self.length
        found, below = [], 0
        while x:
            self._splay(x)
            deeper = right[x]
            if deeper:
                colour[deeper] = colour[x]
            if colour[x] >= 0 and length[x]:
                found.append((colour[x], length[x]))
            right[x] = below
            below, x = x, up[x]
        colour[below] = r
        return found


def _runs_within(ids: np.ndarray, least: int) -> dict[tuple[int, int], int]:
    """(start, period) -> end (exclusive) of every run of ``ids``."""
    ends: dict[tuple[int, int], int] = {}
    reader = LastEnds(len(ids))
    for r, w in enumerate(ids.tolist()):
        for e, past in reader.append(w):
            if r - e <= past:
                ends[e - past + 1, r - e] = r + 1
    return {(s, q): e for (s, q), e in ends.items() if e - s >= max(least, 2 * q)}


def covered(ids: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The stretches (start, end) of words that lie in sequences of ``width`` words found twice (by their hash)."""
    n = len(ids) - width + 1
    if n < 2:
        return []
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        h = h * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + n]
    order = np.sort(h)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return []
    place = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
    at = np.flatnonzero(twice[place] == h)
    edge = np.zeros(len(ids) + 1, dtype=np.int32)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    inside = np.concatenate([[0], (np.cumsum(edge[:-1]) > 0).astype(np.int8), [0]])
    change = np.flatnonzero(np.diff(inside))
    return list(zip(change[::2].tolist(), change[1::2].tolist()))


def find_runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the words numbered ``ids``, by start and period."""
    out = []
    for a, b in covered(ids, -(-least // 2)):
        if b - a >= least:
            out += [(a + s, e - s, q) for (s, q), e in _runs_within(ids[a:b], least).items()]
    return sorted(out, key=lambda x: (x[0], x[2]))


def word_ids(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers, in order of first sight."""
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    return np.fromiter(map(number.__getitem__, words), dtype=np.int32, count=len(words))


def collapse(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words stay when of every run only its first period does."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, size, q in runs:
        edge[start + q] += 1
        edge[start + size] -= 1
    return np.cumsum(edge[:-1]) == 0


_FIELDS = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def describe(words: list[bytes], least: int = LEAST) -> tuple:
    """``_FIELDS`` of one text, given as its words."""
    found = find_runs(word_ids(words), least)
    best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
    start, size, q = best or (None, None, None)
    listed = "".join(f"{s},{m},{p}\n" for s, m, p in found)
    if found:
        words = [words[i] for i in np.flatnonzero(collapse(len(words), found)).tolist()]
    return (len(found), start, size, q, best and 1000 * size // q, hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(b" ".join(words)).hexdigest())


def text_runs(docs: DataFrame, rewrite=None, key: Column | None = None, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_runs; start, length, period and exponent_milli of the longest run (ties: the
    first, then the shortest period); runs_sha256 over ``start,length,period`` lines; collapsed_sha256 over the words that
    stay. ``rewrite(words, key)`` may change the words first, given the long ``key`` (null where there is none).
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):                # few texts at a time: they may be long
                part, out = batch.slice(at, 64), []
                for text, k in zip(part.column(1), part.column(2)):
                    words = (text.as_py() or b"").split()
                    out.append(describe(rewrite(words, k.as_py()) if rewrite else words, least))
                columns = [pa.array(c, pa.string() if name.endswith("sha256") else pa.int64()) for name, c in zip(_FIELDS, zip(*out))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["doc_id", *_FIELDS])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"),
                       (F.lit(None) if key is None else key).cast("long").alias("key"))
    kinds = ", ".join(f"{name} {'string' if name.endswith('sha256') else 'long'}" for name in _FIELDS)
    return rows.mapInArrow(scan, f"doc_id long, {kinds}")
