"""Repeated windows by content routing, shared by the two substring operators.

A window (so many consecutive words or bytes) is routed by its minimiser: the
smallest hash of the short grams in it, so equal windows meet in one bucket
wherever they come from. Consecutive windows with one minimiser form a segment and travel
together. Only what can matter moves:

1. ``shared_segments``: segments as (key, seg, doc, th, start, n) without text; keys that
   occur once are dropped (a bounded bitmap first, then a join).
2. Segments equal as a whole (key and segment hash, 128 bits together) collapse to one
   representative with a count, so a group of copies costs one string however large it is.
3. ``cut``: the text of representatives whose key has several different segments is cut
   from the documents and goes to its bucket, where the operator compares windows exactly.
4. A key with more than ``hot`` different segments is split: its windows are dealt out by
   128-bit fingerprints instead (the operators' ``hot`` paths).
5. ``repeated_ranges``: what was found goes back to every occurrence.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import (NO_ID, as_long, filter_by, id_filter, materialise, mix, powers, prefix_hash, range_hash,
                                   text_slices, window_min)

SEGMENT = "key long, seg long, doc long, th long, start int, n int, own boolean"
TEXT = "key long, seg long, first long, text binary"
RUNS = "key long, seg long, runs array<struct<off:int,n:int>>"
#: Windows of one segment: a longer run (periodic text) is cut; windows still meet by their key.
LONGEST = 1024
HOT = 4096
SHARD_BYTES = 2 << 20


def corpus(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, th, text): a document is its id and its text; a null id sorts last."""
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))


def runs_of_minimisers(values: np.ndarray, edges: np.ndarray, width: int, gram: int, own: bool):
    """Segments of a slice: ``values`` are element hashes, ``edges`` the first element of
    each row (length rows + 1). Returns key, seg, row, first window, windows, own: whether the
    key stands more than once in the segment, so that windows may repeat inside it."""
    none = np.empty(0, np.int64)
    n = len(values)
    if n < width:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none.astype(bool)
    sums = prefix_hash(values)
    grams = mix((sums[0, gram:] - sums[0, :-gram]) * powers(n - gram + 1, inverse=True))
    reach = width - gram + 1
    low = window_min(grams, reach)
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    valid = row[:n - width + 1] == row[width - 1:]
    change = np.ones(len(low), bool)
    change[1:] = (low[1:] != low[:-1]) | ~valid[:-1] | (row[1:len(low)] != row[:len(low) - 1])
    first = np.flatnonzero(valid & change)
    if not len(first):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none, none.astype(bool)
    stop = np.append(np.flatnonzero(change | ~valid), len(low))
    last = stop[np.searchsorted(stop, first, "right")]
    pieces = -(-(last - first) // LONGEST)
    if pieces.max() > 1:
        piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin, last = np.repeat(first, pieces) + piece * LONGEST, np.repeat(last, pieces)
        first, last = begin, np.minimum(begin + LONGEST, last)
    key = low[first]
    seg = range_hash(sums, first, last + width - 1)
    repeats = np.zeros(len(first), bool)
    if own:
        entering = np.zeros(len(low) + 1, np.int64)
        np.cumsum(grams[reach - 1:] == low, out=entering[1:])
        more = entering[last] - entering[first + 1]  # the key enters again after the first window
        repeats = more > 0
        # A key that has just entered stands once in the first window; any other is counted there.
        older = np.flatnonzero(~((grams[first + reach - 1] == key) & (first > 0) & (low[np.maximum(first - 1, 0)] > key) & valid[np.maximum(first - 1, 0)]) & ~repeats)
        for part in np.array_split(older, max(1, len(older) // 8192)):
            if len(part):
                inside = grams[first[part][:, None] + np.arange(reach)] == key[part][:, None]
                times = inside.sum(axis=1)
                repeats[part] = (times > 1) | (more[part] + times > 1)
    return key, seg, row[first], first, last - first, repeats


def segment_batches(elements: Callable, width: int, gram: int, own: bool):
    """A mapInArrow function: documents in, segments out."""
    def run(batches):
        for batch in batches:
            doc, th = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            for at, rows, data, offsets in text_slices(batch):
                values, edges = elements(data, offsets)
                key, seg, row, first, n, repeats = runs_of_minimisers(values, edges, width, gram, own)
                yield pa.RecordBatch.from_arrays(
                    [as_long(key), as_long(seg), as_long(doc[at:at + rows][row]), as_long(th[at:at + rows][row]),
                     pa.array((first - edges[row]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(repeats)],
                    names=["key", "seg", "doc", "th", "start", "n", "own"])
    return run


def shared_segments(texts: DataFrame, segments: Callable, keep: str) -> DataFrame:
    """Segments whose key passes ``keep`` (over copies, first_doc, last_doc, own), with
    ``many``: whether the key has different segments or repeats inside one."""
    every = texts.mapInArrow(segments, SEGMENT)
    keys = (every.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"),
                                     F.max("own").alias("own"), F.min("seg").alias("a"), F.max("seg").alias("b"))
            .filter(keep).select("key", (F.expr("a <> b") | F.col("own")).alias("many")))
    keys = materialise(keys, "shared-keys")
    bitmap = id_filter(keys, "key")
    return materialise(filter_by(every.drop("own"), bitmap, "key").join(keys, "key"), "shared-segments")


def representatives(shared: DataFrame, hot: int) -> DataFrame:
    """(key, seg, rep, copies, many, hot): one row for each different segment."""
    groups = shared.groupBy("key", "seg").agg(F.min(F.struct("doc", "th", "start", "n")).alias("rep"),
                                              F.count("*").alias("copies"), F.max("many").alias("many"))
    groups = materialise(groups, "segment-groups")
    wide = materialise(groups.groupBy("key").agg(F.count("*").alias("segments")).filter(F.col("segments") > hot)
                       .select("key", F.lit(True).alias("hot")), "hot-keys")
    return materialise(groups.join(wide, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False))), "representatives")


def cut(texts: DataFrame, groups: DataFrame, slicer: Callable) -> DataFrame:
    """TEXT rows (and ``hot``) of the representatives that need a comparison."""
    wanted = (groups.filter("many").select("rep.*", "key", "seg", "hot").groupBy("doc", "th")
              .agg(F.collect_list(F.struct("key", "seg", "start", "n", "hot")).alias("cuts")))
    wanted = materialise(wanted, "cuts")
    some = filter_by(texts, id_filter(wanted, "doc", "th"), "doc", "th").dropDuplicates(["doc", "th"])

    def run(batches):
        for batch in batches:
            for doc, text, cuts in zip(batch.column("doc").to_pylist(), batch.column("text"), batch.column("cuts")):
                cuts = cuts.as_py()
                pieces = slicer((text.as_py() or "").encode(), [(c["start"], c["n"]) for c in cuts])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c["key"] for c in cuts], pa.int64()), pa.array([c["seg"] for c in cuts], pa.int64()),
                     pa.array([doc] * len(cuts), pa.int64()), pa.array(pieces, pa.binary()), pa.array([c["hot"] for c in cuts], pa.bool_())],
                    names=["key", "seg", "first", "text", "hot"])

    return some.join(wanted, ["doc", "th"]).select("doc", "text", "cuts").mapInArrow(run, TEXT + ", hot boolean")


def by_shard(find: Callable):
    """A mapInArrow function over rows sorted by key: ``find(keys, segs, firsts, texts)`` gets
    whole keys, about SHARD_BYTES at a time, and yields (row, offsets, counts)."""
    def run(batches):
        held: list = []
        size = 0
        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if size >= SHARD_BYTES and row[0] != held[-1][0]:
                    yield from emit(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield from emit(held)

    def emit(rows):
        keys, segs, firsts, texts = (list(x) for x in zip(*rows))
        out = [(keys[r], segs[r], [{"off": int(o), "n": int(n)} for o, n in zip(off, count)]) for r, off, count in find(firsts, texts)]
        if out:
            k, s, runs = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(k, pa.int64()), pa.array(s, pa.int64()), pa.array(runs, pa.list_(pa.struct([("off", pa.int32()), ("n", pa.int32())])))],
                names=["key", "seg", "runs"])
    return run


def flagged_runs(flags: np.ndarray, owner: np.ndarray, offset: np.ndarray):
    """(row, offsets, lengths) of the maximal runs of flagged windows; the arrays have
    one entry for each window, in text order."""
    on = np.flatnonzero(flags)
    if not len(on):
        return
    breaks = np.flatnonzero((np.diff(on) != 1) | (np.diff(owner[on]) != 0)) + 1
    begin, end = on[np.append(0, breaks)], on[np.append(breaks - 1, len(on) - 1)]
    rows = owner[begin]
    edges = np.append(np.flatnonzero(np.append(True, np.diff(rows) != 0)), len(rows))
    for a, b in zip(edges[:-1], edges[1:]):
        yield int(rows[a]), offset[begin[a:b]], end[a:b] - begin[a:b] + 1


def repeated_ranges(shared: DataFrame, groups: DataFrame, found: DataFrame, whole: str) -> DataFrame:
    """(doc, th, runs): runs of flagged windows per document. An occurrence takes all its
    windows where ``whole`` holds (over doc, rep, copies), else what its bucket found."""
    found = found.select(F.col("key").alias("_k"), F.col("seg").alias("_s"), "runs")
    known = materialise(groups.join(found, (F.col("key") == F.col("_k")) & (F.col("seg") == F.col("_s")), "left")
                        .filter("copies > 1 OR runs IS NOT NULL")
                        .select("key", "seg", "rep", "copies", "runs"), "known")
    hits = shared.join(known, ["key", "seg"]).select(
        "doc", "th", F.expr(f"CASE WHEN {whole} THEN array(struct(start AS off, n)) "
                            "ELSE transform(runs, r -> struct(start + r.off AS off, r.n AS n)) END").alias("r"))
    return materialise(hits.filter("size(r) > 0").groupBy("doc", "th").agg(F.flatten(F.collect_list("r")).alias("runs")), "ranges")


def finish(docs: DataFrame, id_col: str, text_col: str, ranges: DataFrame, last: Callable, columns: str) -> DataFrame:
    """``last`` (a mapInArrow function over id, text, runs) on every document: those that the
    bitmap rules out keep their place, the others meet their ranges."""
    bitmap = materialise(id_filter(ranges, "doc", "th"), "bitmap")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
                       F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, {columns}"
    rest = filter_by(rows, bitmap, "doc", "th", how="left_anti").select("id", "text", F.lit(None).cast("array<struct<off:int,n:int>>").alias("runs"))
    some = filter_by(rows, bitmap, "doc", "th").join(ranges, ["doc", "th"], "left").select("id", "text", "runs")
    return rest.mapInArrow(last, schema).unionByName(some.mapInArrow(last, schema)).withColumnRenamed("id", id_col)
