"""Benchmark decontamination against brute force."""

import itertools
import re

from helpers import empty, frame, odd_rows, prose, with_extras

from lakeledger.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def expected(rows, items, width=10):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(0, len(w) - width) + 1):
            if w and item is not None:
                windows.setdefault(tuple(w[i:i + width]), set()).add(str(item))
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for i in range(len(w)):
            for n in {len(k) for k in windows}:
                if len(w[i:i + n]) == n and tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((d, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    passage = " ".join(prose(1, 30))
    common = "the the the the the the the the the the the the"
    items = [(1, passage), (2, passage.upper() + "!"), (10, "tiny item"), (11, "solo"), (12, ""), (13, None), (None, "tiny item"), (14, common), (15, "ÄÖ é 日本"),
             (16, " ".join(prose(2, 12)))]
    rows = odd_rows(passage) + [(50, "x Tiny-item, y"), (51, common + " the the"), (52, "ÄÖ,é.日本"), (53, "äö é 日本"), (54, " ".join(prose(2, 11))),
                                (55, "solo " * 5), (56, passage[5:]), (57, "tiny  big item")]
    got = D.decontaminate(with_extras(frame(spark, rows)), with_extras(frame(spark, items, "item_id long, text string")))
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items"], r["contaminated"]) for r in got.collect()), key=repr) == expected(rows, items)


def test_without_broadcast_and_with_other_widths(spark, monkeypatch):
    monkeypatch.setattr(D, "BROADCAST_BYTES", 0)
    passage = " ".join(prose(1, 30))
    rows, items = odd_rows(passage), [(1, passage), (2, "one two")]
    for width, rarest in ((3, 1), (4, 4)):
        got = D.decontaminate(frame(spark, rows), frame(spark, items, "item_id long, text string"), width=width, rarest=rarest)
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items"], r["contaminated"]) for r in got.collect()), key=repr) == expected(rows, items, width)


def test_proximity_matches(spark):
    item = "alpha beta gamma delta"
    docs = frame(spark, [(1, "x alpha beta gamma delta y"), (2, "alpha so beta gamma delta"), (3, "alpha one two three beta gamma delta"), (4, "delta gamma")])
    found, _ = D.find(docs, frame(spark, [(1, item)], "item_id long, text string"), slop=1)
    got = {r["doc"]: (len(r["hits"]), len(r["near"])) for r in found.collect()}
    assert got == {1: (1, 0), 2: (0, 1)}


def near_expected(rows, items, slop, width):
    windows = {tuple(w[i:i + width]) for _, t in items for w in [words(t)] for i in range(max(0, len(w) - width) + 1) if w}
    out = []
    for d, t in rows:
        w = words(t)
        near = 0
        for p in windows:
            spots = [s for s in range(len(w) + slop) if all(x in w[max(0, s + k - slop):s + k + slop + 1] for k, x in enumerate(p))]
            for _, run in itertools.groupby(enumerate(spots), lambda x: x[1] - x[0]):
                near += all(tuple(w[s:s + len(p)]) != p for _, s in run)
        out.append((d, near))
    return sorted(out, key=repr)


def test_proximity_against_brute_force(spark):
    item = prose(1, 14)
    rows = odd_rows(" ".join(item))[:7]
    for i in range(6):  # words left out, put in, changed over, replaced
        w = list(item)
        w.insert(2 * i, "filler") if i % 3 == 0 else w.pop(2 * i) if i % 3 == 1 else w.__setitem__(slice(i, i + 2), w[i:i + 2][::-1])
        rows.append((200 + i, "before " * i + " ".join(w) + " after"))
    rows += [(300, " ".join([item[0], item[4], item[7], *["f"] * 7])), (301, " ".join(x for w in item for x in (w, "f"))), (302, "a b a b a b a"), (303, " ".join(["q", *item[:9], "q", item[9]]))]
    items = [(1, " ".join(item)), (2, "a b c"), (3, "b a"), (4, None), (5, "solo")]
    for slop, width in ((1, 10), (2, 5)):
        got = D.decontaminate(frame(spark, rows), frame(spark, items, "item_id long, text string"), width=width, slop=slop).collect()
        assert sorted(((r["doc_id"], r["n_near"]) for r in got), key=repr) == near_expected(rows, items, slop, width)
        assert sorted(((r["doc_id"], r["n_hit"]) for r in got), key=repr) == [(r[0], r[2]) for r in expected(rows, items, width)]
        assert sum(r["n_near"] > 0 for r in got) > 3


def test_empty_tables(spark):
    items = frame(spark, [(1, "some words here")], "item_id long, text string")
    assert D.decontaminate(empty(spark), items).collect() == []
    got = D.decontaminate(frame(spark, [(1, "some words here")]), empty(spark, "item_id long, text string")).collect()
    assert [(r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got] == [(3, 0, [], False)]
