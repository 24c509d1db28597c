"""Periodic runs against a plain search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import empty, frame, odd_rows, prose, with_extras

from lakeledger.llm import periodic as P
from lakeledger.llm.queries import QUERIES


def plain_runs(words, least=24, times=3):
    """(start, period, length) of every run, period by period."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > a and i - a + q >= max(least, times * q):
                found.setdefault((a, i - a + q), q)
            i = max(i, a + 1)
    return sorted((a, q, n) for (a, n), q in found.items())


def plain_row(words):
    runs = plain_runs(words)
    drop = {i for a, q, n in runs for i in range(a + q, a + n)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1])) if runs else None
    return runs, best, " ".join(w for i, w in enumerate(words) if i not in drop)


def random_words(r):
    n, kind = r.choice([0, 1, 5, 24, 30, 80, 200, 400]), r.random()
    if kind < 0.3:
        return [r.randrange(r.choice([1, 2, 5])) for _ in range(n)]
    if kind < 0.6:  # one period, with errors
        p = r.randint(1, max(1, n // 3))
        out = ([r.randrange(4) for _ in range(p)] * (n // p + 1))[:n]
        for _ in range(r.randint(0, 3)):
            if out:
                out[r.randrange(n)] = r.randrange(4)
        return out
    if kind < 0.8:  # runs of runs
        out = []
        while len(out) < n:
            out += [r.randrange(3) for _ in range(r.randint(1, 20))] * r.randint(1, 8)
        return out[:n]
    a, b = [0], [0, 1]  # Fibonacci words
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_match_a_plain_search():
    r = random.Random(11)
    for t in range(150):
        docs = [random_words(r) for _ in range(r.randint(1, 6))]
        docs += [list(docs[0])] * (t % 3 == 0)  # a copy beside its original
        words = np.array([w for d in docs for w in d], np.int64)
        edges = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        d, s, n, p = P.runs_of(words, edges)
        for k, doc in enumerate(docs):
            assert [(int(a), int(c), int(b)) for x, a, b, c in zip(d, s, n, p) if x == k] == plain_runs(doc)


@pytest.mark.parametrize("least,times", [(6, 2), (10, 4)])
def test_other_bounds(least, times):
    r = random.Random(3)
    for _ in range(60):
        doc = random_words(r)
        d, s, n, p = P.runs_of(np.array(doc, np.int64), np.array([0, len(doc)]), least, times)
        assert sorted((int(a), int(c), int(b)) for a, b, c in zip(s, n, p)) == plain_runs(doc, least, times)


def test_extensions_match_a_plain_comparison():
    r = random.Random(7)
    x = np.array([r.randrange(2) for _ in range(P.V * 40)] * 2 + [5] + [7] * (P.V - 1), np.int32)
    index = P.CoverIndex(x)
    places = [b * P.V + int(c) for b in range(80) for c in P.COVER]
    for _ in range(400):
        i, j = r.sample(places, 2)
        n = 0
        while max(i, j) + n < len(x) and x[i + n] == x[j + n]:
            n += 1
        assert index.extend(np.array([i]), np.array([j]))[0] == n


def test_pairs_in_several_portions(monkeypatch):
    doc = [1, 2, 3] * 60 + [4] * 200 + [5, 6] * 70
    want = P.runs_of(np.array(doc), np.array([0, len(doc)]))
    monkeypatch.setattr(P, "PAIRS", 50)
    got = P.runs_of(np.array(doc), np.array([0, len(doc)]))
    assert [a.tolist() for a in got] == [a.tolist() for a in want]


def test_odd_rows(spark):
    rows = odd_rows(" ".join(prose(1, 60))) + [(20, "x " + "la di da " * 40 + "y"), (20, "x " + "la di da " * 40 + "y"), (21, "z " * 5000), (None, "q " * 30)]
    out = P.find_runs(with_extras(frame(spark, rows))).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.collapsed) for r in out) == sorted(
        (i or -1, len(t), plain_row(t)[2]) for i, t in ((i, (t or "").replace("\n", " ").replace("\t", " ").split(" ") if t else []) for i, t in rows)
        for t in [[w for w in t if w]])
    for r in out:
        assert [(x.start, x.period, x.length) for x in r.runs] == sorted((x.start, x.period, x.length) for x in r.runs)
        assert (r.best is None) == (not r.runs)
    assert P.find_runs(empty(spark)).collect() == []
    assert P.find_runs(frame(spark, [("a", "b " * 40)], "doc_id string, text string")).first().best.length == 40


def test_query_matches_a_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    planted = 0
    for row in QUERIES["op11_periodic_runs"](spark, sf).collect():
        words = [w.decode() for w in (texts[row.doc_id] or "").encode().split()]
        h, n = zlib.crc32(str(row.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
        if n > 2500:  # the plain search is quadratic
            continue
        runs, best, left = plain_row(words)
        planted += bool(runs)
        lines = "".join(f"{a},{n},{q}\n" for a, q, n in runs)
        assert (row.n_runs, row.runs_sha256, row.collapsed_sha256) == (
            len(runs), hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())
        assert (row.start, row.period, row.length, row.exponent_milli) == ((*best, 1000 * best[2] // best[1]) if best else (None,) * 4)
    assert planted > 10
