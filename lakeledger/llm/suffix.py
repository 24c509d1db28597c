"""Suffix-array deduplication of byte strings.

Texts are split into shards so that equal strings meet (``segments``: 200-byte windows routed by
their minimiser, equal stretches collapsed first). A shard's suffix array is built by
Larsson-Sadakane refinement in numpy (groups that share a prefix are sorted by the rank of the suffix behind
it, the prefix doubling each time; groups of one are left alone), common prefixes by Kasai's
rule, run over many stretches of the text side by side. Neighbours in a suffix array that share
``width`` bytes are repeats. A key that is too large for one shard is cut into several; their
windows are then merged by binary search in sorted fingerprint runs (``_merge``).

Every byte covered by a ``width``-byte string that also starts anywhere else, in the same
document or another, is removed.

Defined results: null is empty; a text shorter than the width stays whole; a row that repeats
another is another place, so both lose what they share; other columns are dropped; what is left is
bytes (a cut may fall inside a character).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm import segments as S
from lakeledger.llm.common import byte_values, merge_runs, prefix_hash, range_hash
from lakeledger.llm.segments import SHARD_BYTES, flagged_runs

WIDTH = 200
GRAM = 24
#: Stands between the strings of a shard; no UTF-8 text holds this byte.
GAP = 0xFF


def _elements(data, offsets):
    return byte_values(data), offsets


def _slicer(width):
    def run(text: bytes, cuts):
        return [text[a:a + n + width - 1] for a, n in cuts]
    return run


def _words(data: np.ndarray, pad: int, high_first: bool) -> np.ndarray:
    """The 8 bytes from every position on as one number."""
    v = np.concatenate([data, np.full(pad + 8, GAP, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):
        bits = np.uint64(8 * k)
        v = (v[:-k] << bits) | v[k:] if high_first else v[:-k] | (v[k:] << bits)
    return v[:len(data) + pad]


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: sort by 8 bytes, then refine the groups that are still tied. What lies past the end is
    greater than all text, as in the sorted bytes, and the greater the further: one order at any depth."""
    n = len(data)
    key = _words(data, 0, high_first=True)
    sa = np.argsort(key)
    first = np.ones(n, bool)
    first[1:] = key[sa[1:]] != key[sa[:-1]]
    del key
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    h = 8
    while True:
        tied = np.flatnonzero(~first | np.append(~first[1:], False))
        if not len(tied):
            return sa
        at = sa[tied]
        pair = rank[at] * (n + h) + np.where(at + h < n, rank[np.minimum(at + h, n - 1)], at + h)
        order = np.argsort(pair)
        pair, at = pair[order], at[order]
        sa[tied] = at
        new = np.append(True, pair[1:] != pair[:-1])
        first[tied] = new
        rank[at] = np.maximum.accumulate(np.where(new, tied, 0))
        h *= 2


def common_prefixes(data: np.ndarray, sa: np.ndarray, cap: int, steps: int = 256) -> np.ndarray:
    """Kasai: for every rank the length, up to ``cap``, of the prefix shared with the rank before.
    The text is cut into stretches of ``steps`` positions that advance together."""
    n = len(data)
    word = _words(data, cap + 8, high_first=False)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    lane = np.arange(0, n, steps)
    h = np.zeros(len(lane), np.int64)
    by_place = np.zeros(n, np.int64)
    for j in range(min(steps, n)):
        p = lane + j
        if p[-1] >= n:
            lane, h, p = lane[:-1], h[:-1], p[:-1]
        q = before[p]
        h = np.where(q < 0, 0, np.maximum(h - 1, 0))
        go = np.flatnonzero((q >= 0) & (h < cap))
        while len(go):
            differ = word[p[go] + h[go]] ^ word[q[go] + h[go]]
            equal = (np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3).astype(np.int64)
            h[go] += equal
            go = go[(equal == 8) & (h[go] < cap)]
        h = np.minimum(h, cap)
        by_place[p] = h
    return by_place[sa]


def _shard(texts, width):
    """(data, starts, sa, shared): the shard's text, where each string begins, its suffix array and
    for every rank whether it shares ``width`` bytes with the rank before."""
    data = np.frombuffer(b"".join(t + bytes([GAP]) for t in texts), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    sa = suffix_array(data)
    return data, np.cumsum(lengths) - lengths, lengths, sa, common_prefixes(data, sa, width) >= width


def _exact(width):
    def find(firsts, texts):
        data, starts, lengths, sa, shared = _shard(texts, width)
        flags = np.zeros(len(data), bool)
        flags[sa[shared]] = True
        flags[sa[np.flatnonzero(shared) - 1]] = True
        owner = np.repeat(np.arange(len(texts)), lengths)
        flags &= np.arange(len(data)) + width < (starts + lengths)[owner]  # not across a gap
        yield from flagged_runs(flags, owner, np.arange(len(data)) - starts[owner])
    return find


_SINGLE, _PROOF, _REPEAT = 0, 1, 2
_HOT = "f1 long, f2 long, key long, seg long, off int, kind int"


def _hot_shards(width):
    """Shards of split keys: repeats inside the shard, and a fingerprint for every different window."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                held.append(row)
                size += len(row[2])
                if size >= SHARD_BYTES:
                    yield emit(held)
                    held, size = [], 0
        if held:
            yield emit(held)

    def emit(rows):
        keys, segs, texts = zip(*rows)
        data, starts, lengths, sa, shared = _shard(texts, width)
        owner = np.repeat(np.arange(len(texts)), lengths)
        is_window = np.arange(len(data)) + width < (starts + lengths)[owner]
        follows = np.append(shared[1:], False)
        kind = np.empty(len(data), np.int32)
        kind[sa] = np.where(shared, _REPEAT, np.where(follows, _PROOF, _SINGLE))
        at = np.flatnonzero(is_window)
        sums = prefix_hash(byte_values(data))
        f1 = range_hash(sums, at, at + width)
        values = byte_values(data)
        f2 = range_hash(prefix_hash(values ^ (values >> np.uint64(7))), at, at + width)
        own = owner[at]
        return pa.RecordBatch.from_arrays(
            [pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(np.array(keys, np.int64)[own]), pa.array(np.array(segs, np.int64)[own]),
             pa.array((at - starts[own]).astype(np.int32)), pa.array(kind[at])], names=["f1", "f2", "key", "seg", "off", "kind"])
    return run


def _merge(batches):
    """Fingerprints of several shards in sorted order, a batch at a time: each single window is looked up by binary search in its
    batch. Of a fingerprint that may go on in the next batch only the value is kept, and its window while it is the only one."""
    last, alone = None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        both = np.empty(n, [("a", np.int64), ("b", np.int64)])
        both["a"], both["b"] = batch.column("f1").to_numpy(), batch.column("f2").to_numpy()
        rows = batch.select(["key", "seg", "off"])
        is_single = batch.column("kind").to_numpy() == _SINGLE
        single = np.flatnonzero(is_single)
        lo, hi = np.searchsorted(both, both[single], "left"), np.searchsorted(both, both[single], "right")
        again = hi - lo > 1
        goes_on = both[0].item() == last
        if goes_on:
            again |= lo == 0
            if alone is not None:
                yield alone
        yield rows.take(pa.array(single[again]))
        last = both[-1].item()
        begin = int(np.searchsorted(both, both[-1], "left"))
        alone = rows.slice(n - 1) if begin == n - 1 and is_single[-1] and not (goes_on and begin == 0) else None


def _split(hot: DataFrame, width: int) -> DataFrame:
    rows = S.materialise(hot.select("key", "seg", "first", "text").repartition(F.col("seg")).mapInArrow(_hot_shards(width), _HOT), "hot-shards")
    across = (rows.filter(F.col("kind") < _REPEAT).repartition("f1").sortWithinPartitions("f1", "f2")
              .mapInArrow(_merge, "key long, seg long, off int"))
    inside = rows.filter(F.col("kind") > _SINGLE).select("key", "seg", "off")
    return across.unionByName(inside).groupBy("key", "seg").agg(F.collect_list(F.struct("off", F.lit(1).alias("n"))).alias("runs"))


def _last(width):
    def run(batches):
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
                data = kept = (text.as_py() or "").encode()
                spans = 0
                if runs:
                    a = np.array([r["off"] for r in runs])
                    s, e = merge_runs(a, a + np.array([r["n"] for r in runs]) + width - 1)
                    edges = [0, *np.stack([s, e], 1).ravel().tolist(), len(data)]
                    kept = b"".join(data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
                    spans = len(s)
                out.append((len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            n, removed, spans, digest, kept = zip(*out) if out else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return run


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, gram: int = GRAM,
                hot: int = S.HOT) -> DataFrame:
    """One row per input row: the id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes that are left)."""
    texts = S.corpus(docs, id_col, text_col)
    gram = min(gram, width)
    shared = S.shared_segments(texts, S.segment_batches(_elements, width, gram, own=True), "copies > 1 OR own")
    groups = S.representatives(shared, hot)
    pieces = S.materialise(S.cut(texts, groups, _slicer(width)), "pieces")
    found = (pieces.filter("NOT hot").select("key", "seg", "first", "text").repartition("key").sortWithinPartitions("key")
             .mapInArrow(S.by_shard(_exact(width)), S.RUNS))
    if not pieces.filter("hot").isEmpty():
        found = found.unionByName(_split(pieces.filter("hot"), width))
    ranges = S.repeated_ranges(shared, groups, found, "copies > 1")
    return S.finish(docs, id_col, text_col, ranges, _last(width),
                    "n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
