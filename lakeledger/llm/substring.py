"""Substring deduplication by super-k-mer partitioning (``segments``): consecutive windows
of words that share a minimiser travel as one packed string to its bucket, where windows are
sorted by rank doubling over exact word numbers, so equal windows are found exactly.

A word is removed when a window that covers it also starts in a document with a smaller id.

Defined results: a null text is empty; a document with fewer words than a window keeps them
all; a null id counts as larger than any other; rows with one id never remove from each other
(a repeated row keeps its words); other columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm import segments as S
from lakeledger.llm.common import merge_runs, prefix_hash, range_hash, word_bounds, word_hashes
from lakeledger.llm.segments import flagged_runs

WINDOW = 50
GRAM = 8


def _elements(data, offsets):
    starts, ends, edges = word_bounds(data, offsets)
    return word_hashes(data, starts, ends), edges


def _slicer(width):
    def run(text: bytes, cuts):
        words = text.split()
        return [b" ".join(words[a:a + n + width - 1]) for a, n in cuts]
    return run


def window_ranks(numbers: np.ndarray, width: int) -> np.ndarray:
    """Equal ranks for equal windows of ``width`` numbers, by sorting pairs of ranks of half the length."""
    rank, length = np.unique(numbers, return_inverse=True)[1].astype(np.int64), 1
    while length < width:
        step = min(length, width - length)
        pair = rank[:len(rank) - step] * (len(numbers) + 1) + rank[step:]
        rank, length = np.unique(pair, return_inverse=True)[1].astype(np.int64), length + step
    return rank


def _exact(width):
    def find(firsts, texts):
        numbers: dict = {}
        words = [t.split() for t in texts]
        counts = np.array([len(w) for w in words])
        ids = np.array([numbers.setdefault(w, len(numbers)) for ws in words for w in ws], np.int64)
        if len(ids) < width:
            return
        owner = np.repeat(np.arange(len(texts)), counts)
        rank = window_ranks(ids, width)
        start = np.flatnonzero(owner[:len(rank)] == owner[width - 1:])
        own, rank = owner[start], rank[start]
        doc = np.array(firsts, np.int64)[own]
        smallest = np.full(rank.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, rank, doc)
        offset = start - (np.cumsum(counts) - counts)[own]
        yield from flagged_runs(smallest[rank] < doc, own, offset)
    return find


def _fingerprints(width):
    """Windows of split keys as (f1, f2, key, seg, first, off)."""
    def run(batches):
        for batch in batches:
            for key, seg, first, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                data = np.frombuffer(text, np.uint8)
                starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
                values = word_hashes(data, starts, ends)
                at = np.arange(len(values) - width + 1)
                f1 = range_hash(prefix_hash(values), at, at + width)
                f2 = range_hash(prefix_hash(values ^ (values >> np.uint64(7))), at, at + width)
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), pa.array([key] * n, pa.int64()), pa.array([seg] * n, pa.int64()),
                     pa.array([first] * n, pa.int64()), pa.array(at.astype(np.int32))], names=["f1", "f2", "key", "seg", "first", "off"])
    return run


def _split(hot: DataFrame, width: int) -> DataFrame:
    rows = hot.select("key", "seg", "first", "text").mapInArrow(_fingerprints(width), "f1 long, f2 long, key long, seg long, first long, off int")
    rows = S.materialise(rows, "hot-windows")
    least = S.materialise(rows.groupBy("f1", "f2").agg(F.min("first").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n"), "hot-least")
    return (rows.join(least, ["f1", "f2"]).filter("least < first").groupBy("key", "seg")
            .agg(F.collect_list(F.struct("off", F.lit(1).alias("n"))).alias("runs")))


def _last(width):
    def run(batches):
        for batch in batches:
            out = []
            for text, runs in zip(batch.column("text"), batch.column("runs").to_pylist()):
                words = (text.as_py() or "").encode().split()
                kept = words
                if runs:
                    a = np.array([r["off"] for r in runs])
                    s, e = merge_runs(a, a + np.array([r["n"] for r in runs]) + width - 1)
                    edges = [0, *np.stack([s, e], 1).ravel().tolist(), len(words)]
                    kept = [w for i in range(0, len(edges), 2) for w in words[edges[i]:edges[i + 1]]]
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept)))
            n, removed, digest, kept = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()),
                 pa.array([k.decode() for k in kept], pa.string())], names=["id", "n_words", "n_removed", "kept_sha256", "kept"])
    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW,
                     gram: int = GRAM, hot: int = S.HOT) -> DataFrame:
    """One row per input row: the id, n_words, n_removed, kept_sha256 and kept (the text that is left, words
    joined by one space)."""
    texts = S.corpus(docs, id_col, text_col)
    gram = min(gram, width)
    shared = S.shared_segments(texts, S.segment_batches(_elements, width, gram, own=False), "first_doc < last_doc")
    groups = S.representatives(shared, hot)
    pieces = S.materialise(S.cut(texts, groups, _slicer(width)), "pieces")
    found = (pieces.filter("NOT hot").select("key", "seg", "first", "text").repartition("key").sortWithinPartitions("key")
             .mapInArrow(S.by_shard(_exact(width)), S.RUNS))
    if not pieces.filter("hot").isEmpty():
        found = found.unionByName(_split(pieces.filter("hot"), width))
    ranges = S.repeated_ranges(shared, groups, found, "doc > rep.doc")
    return S.finish(docs, id_col, text_col, ranges, _last(width), "n_words long, n_removed long, kept_sha256 string, kept string")
