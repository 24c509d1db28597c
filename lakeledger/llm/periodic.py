"""Periodic runs of words, found on a harmonic grid with a difference-cover longest-common-extension index.

A run is a maximal stretch of words with smallest period q (words q apart are equal) that is at least
``least`` words and ``times`` periods long. For every period the pairs (i, i + q) of a grid are looked at whose step is the
number of matches that a run must hold, so each run of that period has a pair on the grid: n/q pairs for a period,
harmonic in all. How far a pair agrees to the right and, on the reversed text, to the left is a longest common
extension: a few words (under V + FEW) are compared, until both positions stand on a difference cover modulo V; from there
the answer is a range minimum (sparse table) over the common prefixes of the sorted suffixes. Only suffixes on the
cover are sorted (6 of 31), by doubling over ranks of V words, and only in documents where some pair gets that far. A stretch that
shows up under several periods is kept with the smallest, which divides the others.

Words are numbered exactly (no hashes). Documents are taken in slices of about 1 MiB; a longer document is a slice of its own.

Defined results: a null or blank text has no words and no runs; a repeated row is a row of its own; the id may be null
and of any type; other columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import SLICE_BYTES, give_back

LEAST, TIMES = 24, 3
#: A perfect difference set modulo 31: for any two residues one shift takes both into it.
V, COVER = 31, np.array([0, 1, 3, 8, 12, 18])
S = len(COVER)
#: Grid pairs looked at together.
PAIRS = 1 << 20
RUN = "struct<start:long,length:long,period:long>"

_SLOT = np.full(V, -1)
_SLOT[COVER] = np.arange(S)
_INSIDE = _SLOT[(np.arange(V)[:, None] + np.arange(V)) % V] >= 0
#: The least shift, of FEW words or more, that takes two residues into the cover. Most pairs end within FEW words and need no index.
FEW = 8
_SHIFT = FEW + np.roll((_INSIDE[:, None, :] & _INSIDE[None, :, :]).argmax(axis=2), (-FEW, -FEW), axis=(0, 1))


def _agree(x: np.ndarray, i: np.ndarray, j: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Equal words from i and j on, at most ``limit``."""
    n = np.zeros(len(i), np.int64)
    live = np.flatnonzero(limit > 0)
    while len(live):
        at = n[live]
        live = live[x[i[live] + at] == x[j[live] + at]]
        n[live] += 1
        live = live[n[live] < limit[live]]
    return n


class CoverIndex:
    """Longest common extensions between cover positions of ``x`` (a whole number of blocks of V, no two suffixes alike)."""

    def __init__(self, x: np.ndarray):
        self.x = np.concatenate([x, np.full(2 * V, -1, x.dtype)])
        place = (np.arange(0, len(x), V)[:, None] + COVER).ravel()
        m = len(place)
        first = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.x, V)[place])
        rank = np.unique(first.view(f"V{first.dtype.itemsize * V}").ravel(), return_inverse=True)[1].astype(np.int64)
        levels, reach = [rank], S
        while rank.max() + 1 < m:
            then = np.zeros(m, np.int64)
            then[:max(m - reach, 0)] = rank[reach:] + 1
            rank = np.unique(rank * (m + 1) + then, return_inverse=True)[1].astype(np.int64)
            levels.append(rank)
            reach *= 2
        self.rank = rank
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(m - 1, np.int64)
        for k in reversed(range(len(levels))):
            same = (a < m) & (b < m)
            same[same] = levels[k][a[same]] == levels[k][b[same]]
            a[same] += S << k
            b[same] += S << k
            common[same] += V << k
        i, j = ((s // S) * V + COVER[s % S] for s in (a, b))
        common += _agree(self.x, i, j, np.full(len(i), V))
        self.table = [common]
        while 2 << (len(self.table) - 1) <= len(common):
            half, last = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def extend(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of cover positions i and j (never equal)."""
        a, b = (self.rank[(p // V) * S + _SLOT[p % V]] for p in (i, j))
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.table[k][lo[at]], self.table[k][hi[at] - (1 << int(k))])
        return out


class Layout:
    """Documents as blocks of V words, each followed by words of its own that stand nowhere else."""

    def __init__(self, words: np.ndarray, edges: np.ndarray):
        self.n = np.diff(edges)
        size = -(-(self.n + 1) // V) * V
        self.begin = V + np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        docs = len(self.n)
        blank = np.concatenate([np.full(V, docs), np.repeat(np.arange(docs), size)])
        at = np.arange(len(words)) + np.repeat(self.begin - edges[:-1], self.n)
        back = np.repeat(2 * self.begin + self.n - 1, self.n) - at
        self.sides = []
        for to in (at, back):
            x = blank.copy()
            x[to] = words + docs + 1
            self.sides.append(x.astype(np.int32))
        self._held: tuple = (None, None)

    def index(self, docs: np.ndarray):
        """CoverIndex of both sides over ``docs`` alone, and where each begins there. The last one is kept."""
        key = docs.tobytes()
        if self._held[0] != key:
            begin, n = self.begin[docs], self.n[docs]
            size = -(-(n + 1) // V) * V
            start = V + np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
            take = np.repeat(begin - start, size) + np.arange(V, V + size.sum())
            moved = np.zeros(len(self.n), np.int64)
            moved[docs] = start - begin
            self._held = (key, ([CoverIndex(np.concatenate([x[:V], x[take]])) for x in self.sides], moved))
        return self._held[1]


def _stretches(layout: Layout, doc: np.ndarray, i: np.ndarray, q: np.ndarray):
    """Matches to the right (at least one) and to the left of the pairs (i, i + q)."""
    mirror = 2 * layout.begin[doc] + layout.n[doc] - 1
    starts = [(i, i + q), (mirror - (i + q - 1), mirror - (i - 1))]
    found, waiting = [], []
    for x, (a, b) in zip(layout.sides, starts):
        shift = _SHIFT[a % V, b % V]
        n = _agree(x, a, b, shift)
        found.append(n)
        waiting.append(np.flatnonzero(n == shift))
    # On the left, a pair at the document's first word meets the word before it, which matches nothing.
    docs = np.unique(np.concatenate([doc[w] for w in waiting]))
    if len(docs):
        indexes, moved = layout.index(docs)
        for index, n, w, (a, b) in zip(indexes, found, waiting, starts):
            by = moved[doc[w]] + n[w]
            n[w] += index.extend(a[w] + by, b[w] + by)
    return found


def runs_of(words: np.ndarray, edges: np.ndarray, least: int = LEAST, times: int = TIMES):
    """(document, start, length, period) of all runs, by document, start and period. ``words`` are the word numbers of
    the documents one after the other, ``edges`` where each begins (and the end)."""
    layout = Layout(words, edges)
    periods = np.where(layout.n >= least, layout.n // times, 0)
    doc = np.repeat(np.arange(len(periods)), periods)
    q = np.arange(len(doc)) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    need = np.maximum(least - q, (times - 1) * q)
    pairs = (layout.n[doc] - q - 1) // need + 1
    total = np.concatenate([[0], np.cumsum(pairs)])
    out, at = [], 0
    while at < len(doc):
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
        count = pairs[at:to]
        owner = np.repeat(np.arange(at, to), count)
        i = layout.begin[doc[owner]] + (np.arange(len(owner)) - (total[owner] - total[at])) * need[owner]
        x = layout.sides[0]
        hit = np.flatnonzero(x[i] == x[i + q[owner]])
        owner, i = owner[hit], i[hit]
        right, left = _stretches(layout, doc[owner], i, q[owner])
        hit = np.flatnonzero(right + left >= need[owner])
        owner = owner[hit]
        start, length = i[hit] - left[hit] - layout.begin[doc[owner]], right[hit] + left[hit] + q[owner]
        out.append(_least_period(doc[owner], start, length, q[owner]))
        at = to
    if not out:
        return (np.empty(0, np.int64),) * 4
    d, s, n, p = _least_period(*(np.concatenate(c) for c in zip(*out)))
    order = np.lexsort((p, s, d))
    return d[order], s[order], n[order], p[order]


def _least_period(d, s, n, p):
    order = np.lexsort((p, n, s, d))
    d, s, n, p = d[order], s[order], n[order], p[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1]) | (n[1:] != n[:-1])
    return d[new], s[new], n[new], p[new]


def _greatest(s, n, p) -> int:
    """The run with the greatest length / period, exactly; ties by start, then period."""
    ratio = n / p
    near = np.flatnonzero(ratio >= ratio.max() * (1 - 1e-9))
    return int(min(near, key=lambda k: (-Fraction(int(n[k]), int(p[k])), s[k], p[k])))


def _slice_rows(texts: list, least: int, times: int):
    """One (n_words, runs, best, collapsed) for each text."""
    split = [t.split() for t in texts]
    numbers: dict = {}
    for words in split:
        for w in words:
            numbers.setdefault(w, len(numbers))
    edges = np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)
    ids = np.fromiter((numbers[w] for words in split for w in words), np.int64, edges[-1])
    d, s, n, p = runs_of(ids, edges, least, times)
    bounds = np.searchsorted(d, np.arange(len(texts) + 1))
    for k, words in enumerate(split):
        a, b = bounds[k], bounds[k + 1]
        runs, best = [], None
        if a < b:
            runs = [{"start": int(x), "length": int(y), "period": int(z)} for x, y, z in zip(s[a:b], n[a:b], p[a:b])]
            best = runs[_greatest(s[a:b], n[a:b], p[a:b])]
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, s[a:b] + p[a:b], 1)
            np.add.at(change, s[a:b] + n[a:b], -1)
            total = len(words)
            words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
            yield total, runs, best, b" ".join(words)
        else:
            yield len(words), runs, best, b" ".join(words)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per input row: the id, n_words, runs (by start, then period; word numbers from 0), best (the run of greatest
    length / period, null without runs) and collapsed: the words, joined by one space, without those that any run
    contains after its first period."""
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            size = np.concatenate([[0], np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in texts])])
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(size, size[at] + SLICE_BYTES, "right")) - 1)
                held = [t or b"" for t in texts.slice(at, to - at).to_pylist()]
                n, runs, best, left = zip(*_slice_rows(held, least, times))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(at, to - at), pa.array(n, pa.int64()), pa.array(runs, pa.list_(kind)), pa.array(best, kind),
                     pa.array(left, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "best", "collapsed"])
                at = to
            give_back()

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, runs array<{RUN}>, best {RUN}, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
