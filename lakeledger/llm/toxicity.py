"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

An n-gram's ratio is log((p + 1) / (P + 2)) - log((q + 1) / (Q + 2)), with p and q the documents of either
label that hold it. N-grams seen in at least ``MIN_DOCS`` documents whose ratio is at least
``MIN_RATIO`` away from zero are features; their value is the ratio if the document holds the n-gram, and a logistic regression
learns a weight for each. The training sample is bounded: at most ``PER_LABEL`` documents of each label, those
with the smallest hashes of their ids.

Defined results: null and empty texts have no features and get the score of the bias; without labelled rows of both labels every
score is 0; labels that are null or belong to no document are ignored, and a document with several
labels counts as toxic if one says so; every row, repeated or not, gets a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import bounded_sample, free_name, materialise, share
from lakeledger.llm.ngrams import grams, lowered, slices

PER_LABEL = 3000
SIZES = (5, 6, 8)
MIN_DOCS = 5
MIN_RATIO = 1.5
FEATURES = 30_000
THRESHOLD = 0.7
_BITS = 20


def _unique(texts, sizes):
    """(hash, row) of the different n-grams of each text."""
    data, row = lowered(texts)
    parts = [grams(data, row, n) for n in sizes]
    h, r = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[first], r[first]


def _count(sizes):
    """Documents of either label for each n-gram of a batch."""
    def run(batches):
        for batch in batches:
            label = np.array(batch.column(1).to_pylist())
            for at, texts in slices(batch.column(0)):
                h, r = _unique(texts, sizes)
                value, where = np.unique(h, return_inverse=True)
                toxic = np.bincount(where, weights=label[at + r], minlength=len(value)).astype(np.int64)
                total = np.bincount(where, minlength=len(value)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(toxic), pa.array(total)], names=["gram", "toxic", "total"])
    return run


class Model:
    """Features (sorted hashes), their weights (ratio included) and the bias."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float, sizes=SIZES):
        self.features, self.weights, self.bias, self.sizes = features, weights, bias, sizes
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[(features & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True

    def found(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) pairs of the texts, each once."""
        data, row = lowered(texts)
        rows, hits = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for n in self.sizes if len(self.features) else ():
            h, r = grams(data, row, n)
            some = np.flatnonzero(self.maybe[(h & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
            h, r = h[some], r[some]
            at = np.minimum(np.searchsorted(self.features, h), len(self.features) - 1)
            same = self.features[at] == h
            rows.append(r[same])
            hits.append(at[same])
        pair = np.unique(np.concatenate(rows) * max(1, len(self.features)) + np.concatenate(hits))
        return pair // max(1, len(self.features)), pair % max(1, len(self.features))

    def scores(self, texts) -> np.ndarray:
        row, hit = self.found(texts)
        z = self.bias + np.bincount(row, weights=self.weights[hit], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _fit(row: np.ndarray, hit: np.ndarray, value: np.ndarray, label: np.ndarray, width: int, rounds: int = 600, ridge: float = 0.1):
    """Logistic regression with an L2 penalty, by gradient steps with momentum; both labels weigh the same."""
    x = value[hit]
    weight = np.where(label == 1, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum())) * len(label)
    w, b = np.zeros(width), 0.0
    vw, vb = np.zeros(width), 0.0
    scale = 1 / (0.25 * max(1.0, np.bincount(row, weights=x * x, minlength=1).max()) * weight.max() + ridge / len(label) + 1)
    for k in range(rounds):
        aw, ab = w + k / (k + 3) * vw, b + k / (k + 3) * vb
        z = ab + np.bincount(row, weights=x * aw[hit], minlength=len(label))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label) / len(label)
        gw = np.bincount(hit, weights=x * error[row], minlength=width) + ridge / len(label) * aw
        nw, nb = aw - scale * gw, ab - scale * error.sum()
        vw, vb, w, b = nw - w, nb - b, nw, nb
    return w, b


def train(labelled: DataFrame, sizes=SIZES) -> Model:
    """``labelled`` has (text, label) with at most a bounded number of rows of each label."""
    counts = labelled.groupBy("label").count().collect()
    size = {r["label"]: r["count"] for r in counts}
    if len(size) < 2:
        return Model(np.empty(0, np.uint64), np.empty(0), -30.0, sizes)
    p_all, q_all = size[1], size[0]
    p, q = F.col("toxic"), F.col("total") - F.col("toxic")
    ratio = F.log((p + 1) / (p_all + 2)) - F.log((q + 1) / (q_all + 2))
    table = (labelled.select("text", "label").mapInArrow(_count(sizes), "gram long, toxic long, total long")
             .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))
             .filter(F.col("total") >= MIN_DOCS).select("gram", ratio.alias("ratio"), "total").filter(F.abs("ratio") >= MIN_RATIO)
             .orderBy((F.abs("ratio") * F.sqrt("total")).desc(), "gram").limit(FEATURES).collect())
    features = np.array([r["gram"] for r in table], np.int64).view(np.uint64)
    order = np.argsort(features)
    features, ratio = features[order], np.array([r["ratio"] for r in table])[order]
    draft = Model(features, ratio, 0.0, sizes)

    def pairs(batches):
        for batch in batches:
            for at, texts in slices(batch.column(0)):
                row, hit = draft.found(texts)
                cut = np.searchsorted(row, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(at, len(texts)), batch.column(2).slice(at, len(texts)), pa.array([hit[a:b].astype(np.int32) for a, b in zip(cut[:-1], cut[1:])], pa.list_(pa.int32()))],
                    names=["label", "place", "hits"])

    rows = labelled.select("text", "label", "place").mapInArrow(pairs, "label int, place long, hits array<int>").orderBy("place").collect()
    hits = [np.array(r["hits"], np.int64) for r in rows]
    row = np.repeat(np.arange(len(hits)), [len(h) for h in hits])
    hit = np.concatenate([np.empty(0, np.int64), *hits])
    weights, bias = _fit(row, hit, ratio, np.array([r["label"] for r in rows]), len(features))
    return Model(features, weights * ratio, bias, sizes)


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, where=None, per_label: int = PER_LABEL) -> DataFrame:
    """(text, label, place): the bounded training sample."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    marks = marks.groupBy("id").agg(F.max("label").alias("label"))
    if where is not None:
        marks = marks.filter(where(F.col("id")))
    marks = materialise(marks, "toxicity-labels")
    chosen = materialise(bounded_sample(marks, per_label, "label", "id"), "toxicity-sample")  # at most 2 * per_label ids
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    # Of several texts with one id the smallest is learnt from.
    texts = texts.groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return materialise(texts.select("text", "label", F.xxhash64("id").alias("place")), "toxicity-texts")


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column of scores; all columns stay."""
    shared = share(docs.sparkSession, model)

    rows = docs.drop(out) if out != text_col else docs.withColumnRenamed(text_col, free_name(docs.columns))
    place = rows.columns.index(text_col) if out != text_col else docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            found = [shared().scores(texts) for _, texts in slices(batch.column(place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.empty(0), *found]))], names=[*batch.schema.names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + f", `{out}` double"
    return rows.mapInArrow(run, schema)
