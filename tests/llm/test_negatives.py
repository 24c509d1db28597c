"""Hard negatives against brute force; the tree's pruning."""

import numpy as np
import pytest
from helpers import empty
from pyspark.sql import functions as F

from lakeledger.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, anchor=lambda i: i % 10 == 0, positives=5, negatives=10):
    """rows: (id, label, whole numbers)."""
    width = max((len(v) for _, _, v in rows), default=0)
    rows = [(i, label, np.array(list(v) + [0] * (width - len(v)), np.int64)) for i, label, v in rows]
    out = []
    for a, la, va in rows:
        if not anchor(a):
            continue
        score = sorted(((-int(va @ v), i, label) for i, label, v in rows if i != a), key=lambda r: r[:2])
        for s, p, _ in [r for r in score if r[2] == la][:positives]:
            found = [(n, i) for n, i, label in score if label != la and 30 * -s <= 100 * -n <= 90 * -s][:negatives]
            out += [(a, p, k + 1, i, -s, -n) for k, (n, i) in enumerate(found)]
    return sorted(out)


def clustered(seed, n, dim, labels, spread=0.3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(labels, dim))
    label = r.integers(0, labels, n)
    x = centres[label] * 0.2 + r.normal(size=(n, dim)) * spread
    return [(i, [float(c) for c in np.float32(x[i])], int(label[i])) for i in range(n)]


def whole(rows):
    return [(i, label, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, label in rows]


@pytest.mark.parametrize("seed,n,dim,labels", [(1, 400, 6, 4), (2, 300, 2, 2), (3, 250, 20, 3)])
def test_mining_matches_brute_force(spark, monkeypatch, seed, n, dim, labels):
    monkeypatch.setattr(N, "BLOCK", 16)
    monkeypatch.setattr(N, "CHUNK", 7)
    rows = clustered(seed, n, dim, labels)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(120)]  # many equal vectors: ties by id
    df = spark.createDataFrame(rows, SCHEMA)
    got = N.mine(N.as_rows(df), F.col("id") % 10 == 0, sample=60, degree=4, leaf=4).collect()
    assert sorted(map(tuple, got)) == plain(whole(rows))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.5, 0.1], 2), (3, [0.4], 2), (4, [], 2), (5, [0.5, 0.1], 3), (6, [-1.0, -1.0], 2), (10, [0.0, 0.0], 1), (20, [0.7, 0.7], 9)]
    bad = [(7, None, 1), (8, [1.0, None], 2), (9, [nan, 1.0], 2), (30, [inf, 0.0], 1), (40, [1.0, 1.0], None), (None, [0.5, 0.5], 2), (11, [-inf], 2)]
    again = [good[2], good[0], (1, [5.0, 5.0], 3)]  # repeated rows, and an id that stands twice: the smaller label counts
    df = spark.createDataFrame(good + bad + again, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "vec", "x", "leaf", "given", "score")})
    got = N.mine(N.as_rows(df), F.col("id") % 10 == 0).collect()
    want = plain(whole(good))
    assert sorted(map(tuple, got)) == want and want
    assert N.mine(N.as_rows(empty(spark, SCHEMA)), F.col("id") % 10 == 0).collect() == []
    assert N.mine(N.as_rows(spark.createDataFrame(bad, SCHEMA)), F.col("id") % 10 == 0).collect() == []


def test_components_too_large_for_exact_scores(spark):
    df = spark.createDataFrame([(0, [1e12], 1), (1, [1e12], 1)], SCHEMA)
    with pytest.raises(ValueError):
        N.mine(N.as_rows(df), F.col("id") % 10 == 0)


def test_the_tree_drops_leaves_and_loses_no_row():
    rows = np.array([v for _, _, v in whole(clustered(4, 3000, 3, 12, spread=0.02))])
    square = float((rows * rows).sum(axis=1).max())
    tree = N.Tree(rows[::7], square, degree=6, leaf=8)
    lifted, seen = tree.lift(rows), {}

    def see(node, d, near):
        for i in range(d.shape[1]):
            for j in np.unique(near):
                a, b = d[near == j, i].min(), d[near == j, i].max()
                low, high = seen.get((node, i, j), (np.inf, -np.inf))
                seen[node, i, j] = min(a, low), max(b, high)
    leaf = tree.leaf_of(lifted, see)
    tree.set_ranges((*k, *v) for k, v in seen.items())
    search = N.Search(tree, 3, "<i8", np.arange(0), np.arange(0), rows[:0])
    anchors = rows[::50]
    scores = anchors @ rows.T
    low, high = np.percentile(scores, 80, axis=1).astype(np.int64), np.percentile(scores, 85, axis=1).astype(np.int64)
    inner, outer = search.annuli(anchors, low, high)
    reached = tree.reached(tree.lift(anchors, anchor=True), inner, outer)
    visited = np.zeros((len(anchors), tree.leaves), bool)
    for k, who in enumerate(reached):
        visited[who, k] = True
    for a in range(len(anchors)):
        inside = (scores[a] >= low[a]) & (scores[a] <= high[a])
        assert visited[a, leaf[inside]].all()
    assert visited.mean() < 0.6  # ranges drop a good part of the leaves
