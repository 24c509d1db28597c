"""Byte and word substring deduplication against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import empty, frame, odd_rows, prose, with_extras
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeledger.llm import substring, suffix
from lakeledger.llm.common import merge_runs, window_min


def corpus():
    passage = " ".join(prose(1, 90))
    shared = " ".join(prose(2, 70))
    near = prose(3, 200)
    rows = odd_rows(passage)
    for i in range(12):
        changed = list(near)
        changed[15 * i] = f"changed{i}"
        rows.append((100 + i, " ".join(changed)))
    rows += [(200 + i, " ".join(prose(20 + i, 60)) + " " + shared + "\n" + " ".join(prose(40 + i, 60))) for i in range(5)]
    return rows + [(300, "ab" * 400), (301, "x" + "ab" * 300), (302, "same words again " * 60)]


def words_expected(rows, width):
    big = 1 << 62
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - width + 1):
            k = tuple(w[i:i + width])
            first[k] = min(first.get(k, big), big - 1 if d is None else d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - width + 1):
            if first[tuple(w[i:i + width])] < (big - 1 if d is None else d):
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def bytes_expected(rows, width):
    count = Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i:i + width] for i in range(len(b) - width + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - width + 1):
            if count[b[i:i + width]] > 1:
                gone[i:i + width] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-2]])).sum()) if len(b) else 0
        out.append((d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def found(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("hot", [4096, 1])
def test_words_against_brute_force(spark, hot):
    rows = corpus()
    got = substring.dedup_substrings(with_extras(frame(spark, rows)), hot=hot)
    assert found(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == sorted(words_expected(rows, 50), key=repr)
    assert all(hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"] for r in got.collect())


@pytest.mark.parametrize("hot", [4096, 1])
def test_bytes_against_brute_force(spark, hot):
    rows = [r for r in corpus() if len(r[1] or "") < 50_000]
    got = suffix.dedup_bytes(with_extras(frame(spark, rows)), hot=hot)
    assert found(got, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]) == sorted(bytes_expected(rows, 200), key=repr)


def test_other_widths(spark):
    rows = [r for r in corpus() if len(r[1] or "") < 5_000]
    df = frame(spark, rows)
    assert found(substring.dedup_substrings(df, width=3), ["doc_id", "n_words", "n_removed", "kept_sha256"]) == sorted(words_expected(rows, 3), key=repr)
    got = suffix.dedup_bytes(df, width=30, gram=10)
    assert found(got, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]) == sorted(bytes_expected(rows, 30), key=repr)


def test_empty_tables(spark):
    assert substring.dedup_substrings(empty(spark)).collect() == []
    assert suffix.dedup_bytes(empty(spark)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab\xff", min_size=1, max_size=80))
def test_suffix_array_and_common_prefixes(text):
    data = np.frombuffer(text.encode("latin-1"), np.uint8)
    raw = data.tobytes()
    sa = suffix.suffix_array(data)
    pad = lambda i: raw[i:] + b"\xff" * 9  # noqa: E731  past the end comes the gap byte
    assert sorted(sa.tolist()) == list(range(len(raw)))
    assert all(pad(a)[:8] <= pad(b)[:8] for a, b in zip(sa, sa[1:]))
    lcp = suffix.common_prefixes(data, sa, 12, steps=7)
    for k in range(1, len(sa)):
        a, b = raw[sa[k - 1]:], raw[sa[k]:]
        true = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert min(true, 12) == lcp[k] or true == min(len(a), len(b))  # at the end the gap may go on


def test_suffixes_have_one_order_up_to_the_end_of_the_text():
    """A tie that ends where the text ends was put first, others last; the prefixes were then carried to other neighbours."""
    rng = random.Random(29)
    texts = ["\xffbba\xff\xff\xff\xffbba", "\xff" * 20, "abababab" * 3, "abcdefg\xffxyzabcdefg\xff"]
    texts += ["".join(rng.choice("ab\xff") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    for text in texts:
        data = np.frombuffer(text.encode("latin-1"), np.uint8)
        raw = data.tobytes()
        sa = suffix.suffix_array(data).tolist()
        assert sa == sorted(range(len(raw)), key=lambda i: [*raw[i:], 256]), text
        lcp = suffix.common_prefixes(data, np.array(sa), 12, steps=7).tolist()
        for a, b, got in zip(sa, sa[1:], lcp[1:]):
            pairs = zip((raw[a:] + b"\xff" * 12)[:12], (raw[b:] + b"\xff" * 12)[:12])
            assert got == next((i for i, (x, y) in enumerate(pairs) if x != y), 12), (text, a, b)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 4), min_size=1, max_size=60), st.integers(1, 9))
def test_window_ranks_and_minima(values, width):
    v = np.array(values, np.uint64)
    assert window_min(v, width).tolist() == [min(values[i:i + width]) for i in range(len(values) - width + 1)]
    if len(values) >= width:
        rank = substring.window_ranks(np.array(values), width)
        groups = {}
        for i, r in enumerate(rank):
            groups.setdefault(tuple(values[i:i + width]), set()).add(int(r))
        assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


def test_merge_runs():
    s, e = merge_runs(np.array([5, 0, 3, 20]), np.array([9, 4, 6, 21]))
    assert list(zip(s.tolist(), e.tolist())) == [(0, 9), (20, 21)]


def thue_morse(n, a="a", b="b"):
    """n letters (a power of two), and the same with the letters changed over: texts on which sums of powers modulo 2**64 agree."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [a if x else b for x in bits], [b if x else a for x in bits]


@pytest.mark.parametrize("hot", [4096, 1])
def test_texts_that_rolling_sums_confuse(spark, hot):
    rows, start = [], prose(77, 80)
    for k, n in enumerate((1024, 2048)):
        one, other = ("".join(t) for t in thue_morse(n))
        rows += [(10 * k + 1, " ".join([*start[:30], one, *start[30:49]])), (10 * k + 2, " ".join([*start[:30], other, *start[30:49]]))]
        # As words, and behind and before the same text: equal windows stand beside unequal ones.
        rows += [(10 * k + 3 + i, " ".join([*start, *t, *start])) for i, t in enumerate(thue_morse(n))]
    got = substring.dedup_substrings(frame(spark, rows), hot=hot)
    want = sorted(words_expected(rows, 50), key=repr)
    assert found(got, ["doc_id", "n_words", "n_removed", "kept_sha256"]) == want
    assert all(r[2] == 0 for r in want if r[0] in (1, 2))
    got = suffix.dedup_bytes(frame(spark, rows), hot=hot)
    assert found(got, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]) == sorted(bytes_expected(rows, 200), key=repr)


def test_range_hashes_tell_thue_morse_texts_apart():
    from lakeledger.llm.common import byte_values, prefix_hash, range_hash
    for n in (1024, 2048, 4096):
        for values in (byte_values, lambda d: byte_values(d) ^ (byte_values(d) >> np.uint64(7))):
            h = [int(range_hash(prefix_hash(values(np.frombuffer("".join(t).encode(), np.uint8))), np.array([0]), np.array([n]))[0]) for t in thue_morse(n)]
            assert h[0] != h[1]
    text = np.frombuffer(b"xx" + b"some words" * 3 + b"y", np.uint8)
    sums = prefix_hash(byte_values(text))
    assert range_hash(sums, np.array([2]), np.array([12]))[0] == range_hash(sums, np.array([12]), np.array([22]))[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(-2, 2), st.integers(0, 1), st.sampled_from([suffix._SINGLE, suffix._PROOF])), max_size=24), st.integers(1, 5))
def test_merge_gives_the_same_whatever_the_batches(found, size):
    """A fingerprint whose rows are spread over batches is one fingerprint; every single window of one that stands twice comes once."""
    found = sorted(found, key=lambda r: r[:2])
    times = Counter(r[:2] for r in found)
    expected = [i for i, r in enumerate(found) if r[2] == suffix._SINGLE and times[r[:2]] > 1]
    batches = []
    for at in range(0, len(found), size):
        f1, f2, kind = zip(*found[at:at + size])
        seg = range(at, at + len(f1))
        batches.append(pa.RecordBatch.from_arrays(
            [pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(seg, pa.int64()), pa.array(seg, pa.int64()),
             pa.array(seg, pa.int32()), pa.array(kind, pa.int32())], names=["f1", "f2", "key", "seg", "off", "kind"]))
        batches.append(batches[-1].slice(0, 0))
    got = [s for b in suffix._merge(batches) for s in b.column("seg").to_pylist()]
    assert sorted(got) == expected
