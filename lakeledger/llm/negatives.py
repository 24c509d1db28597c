"""Hard negatives through a GNAT (geometric near-neighbour access tree).

Every anchor's positives are its best-scored rows of the same label; its hard negatives for a positive are the best rows of
other labels whose score lies in a window below that positive's score. Scores are integer inner products.

Vectors get one more coordinate that brings all of them to one length, so that a score is a Euclidean distance to the anchor and
a window of scores is an annulus around it. The tree is multiway: a node has up to ``DEGREE`` split points, a row goes
to the nearest (hyperplanes between them), and for each pair of split points the node stores the range of distances from the one to the
rows below the other. A search drops a child if, for any split point, the range to that child misses the distances that the
triangle inequality allows to the annulus; what is left are leaves, and leaves are scored exactly, as integers.

Split points come from a bounded sample (``SAMPLE`` rows, chosen by hash); every row is indexed, and the ranges are
those of all rows (aggregated per task, then over tasks), so nothing is missed. The sample's scores also bound each search from below:
the k-th best row cannot be worse than the k-th best of the sample.

Leaves are stored as packed blocks of at most ``BLOCK`` rows, a full leaf (thousands of equal vectors, say) as many blocks spread
over tasks by id. Anchors travel to the leaves they reach in packed chunks of at most ``CHUNK``, and what each pair of block and chunk
finds is cut to the wanted number per anchor before it is shuffled (window group limit). The driver holds the sample and the tree only.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no part; of rows
with one id the smallest (label, vector) stands; a shorter vector is filled up with zeros; a positive is never the anchor's own id; an anchor
with no positive, or a positive without rows in its window, gives no rows; other columns are dropped; an empty table gives
an empty result. Components whose scores could pass 2**53 are refused.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.llm.common import give_back, materialise, share

SCALE = 256
SAMPLE, DEGREE, LEAF = 4096, 16, 32
BLOCK, CHUNK = 512, 64
POSITIVES, NEGATIVES = 5, 10
#: The window below a positive score p: LOW * p <= 100 * score <= HIGH * p.
LOW, HIGH = 30, 90
#: Distances are compared with this slack, relative to the vectors' length; scores are compared exactly.
SLACK = 1e-6
LARGEST = 1 << 53


def as_rows(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", label: Column | None = None) -> DataFrame:
    """(id, label, vec): the rows that take part, components as whole numbers; ``label`` overrides the label column."""
    x = F.transform(vector_col, lambda c: c.cast("double"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = (embeddings.select(F.col(id_col).alias("id"), F.col(label_col).alias("given"), (label if label is not None else F.col(label_col)).alias("label"), x.alias("x"))
            .filter(F.col("id").isNotNull() & F.col("given").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(fine))
    whole = rows.select("id", "label", F.transform("x", lambda c: F.floor(c * SCALE)).alias("vec"))
    return whole.groupBy("id").agg(F.min(F.struct("label", "vec")).alias("r")).select("id", "r.label", "r.vec")


class Tree:
    """Split points and, once known, the ranges of distances below them."""

    def __init__(self, points: np.ndarray, square: float, degree: int = DEGREE, leaf: int = LEAF):
        self.square, self.length = square, float(np.sqrt(square)) or 1.0
        self.nodes: list = []  # (split points, child of each: node number, or -1 - leaf number)
        self.leaves = 0
        self._grow(self.lift(points), degree, leaf)
        self.low: list = []
        self.high: list = []

    def lift(self, vectors: np.ndarray, anchor: bool = False) -> np.ndarray:
        """Vectors with one more coordinate: rows get the common length, anchors get 0 there."""
        x = vectors.astype(np.float64)
        rest = np.zeros(len(x)) if anchor else np.sqrt(np.maximum(self.square - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def _grow(self, x: np.ndarray, degree: int, leaf: int) -> int:
        """The number of the new node, or -1 - number of the new leaf."""
        splits = _spread(x, degree) if len(x) > leaf else []
        if len(splits) < 2:
            self.leaves += 1
            return -self.leaves
        points = x[splits]
        at = len(self.nodes)
        self.nodes.append((points, []))
        near = distances(x, points).argmin(axis=1)
        for j in range(len(points)):
            self.nodes[at][1].append(self._grow(x[near == j], degree, leaf))
        return at

    def leaf_of(self, x: np.ndarray, see=None) -> np.ndarray:
        """The leaf of every lifted row; ``see(node, distances, nearest)`` is told of each split on the way."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.nodes else []
        while todo:
            node, rows = todo.pop()
            points, children = self.nodes[node]
            d = distances(x[rows], points)
            near = d.argmin(axis=1)
            if see:
                see(node, d, near)
            for j, child in enumerate(children):
                below = rows[near == j]
                if len(below) and child >= 0:
                    todo.append((child, below))
                else:
                    out[below] = -1 - child
        return out

    def set_ranges(self, rows) -> None:
        self.low = [np.full((len(p), len(p)), np.inf) for p, _ in self.nodes]
        self.high = [np.full((len(p), len(p)), -np.inf) for p, _ in self.nodes]
        for node, i, j, low, high in rows:
            self.low[node][i, j], self.high[node][i, j] = low, high

    def reached(self, anchors: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> list[np.ndarray]:
        """For every leaf the anchors (numbers) with a row possibly between ``inner`` and ``outer`` of them."""
        out = [np.empty(0, np.int64)] * self.leaves
        todo = [(0, np.arange(len(anchors)))] if self.nodes else []
        if not self.nodes:
            return [np.arange(len(anchors))] * self.leaves
        while todo:
            node, who = todo.pop()
            points, children = self.nodes[node]
            d = distances(anchors[who], points)
            most, least = d + outer[who, None], np.maximum(np.maximum(d - outer[who, None], inner[who, None] - d), 0)
            slack = SLACK * self.length
            # (anchor, split point i, child j): does the range to j meet what the annulus allows?
            meets = (least[:, :, None] <= self.high[node] + slack) & (most[:, :, None] >= self.low[node] - slack)
            keep = meets.all(axis=1)
            for j, child in enumerate(children):
                some = who[keep[:, j]]
                if len(some) and child >= 0:
                    todo.append((child, some))
                elif len(some):
                    out[-1 - child] = some
        return out


def distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * (x @ points.T)
    return np.sqrt(np.maximum(square, 0))


def _spread(x: np.ndarray, degree: int) -> list[int]:
    """Rows far from each other: each is the farthest from those before it."""
    at = [int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmax())]
    near = distances(x, x[at])[:, 0]
    while len(at) < degree and near.max() > 1e-6 * (1 + np.abs(x).max()):
        at.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[at[-1:]])[:, 0])
    return at


# --- packed rows -----------------------------------------------------------------------


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as a matrix, shorter rows filled up with zeros."""
    out = np.zeros((len(column), dim), np.int64)
    column = column.cast(pa.large_list(pa.int64()))
    n = np.diff(column.offsets.to_numpy())
    row = np.repeat(np.arange(len(n)), n)
    out[row, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = column.flatten().to_numpy()
    return out


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _unpack(value, kind="<i8", dim: int | None = None) -> np.ndarray:
    out = np.frombuffer(value.as_buffer(), kind)
    return out if dim is None else out.reshape(-1, dim)


def _best(a: np.ndarray, r: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the (anchor, row) positions those of each anchor's k best rows by score, then by id."""
    order = np.lexsort((ids[r], -points[a, r], a))
    a, r = a[order], r[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    place = np.arange(len(a)) - np.repeat(first, np.diff(np.append(first, len(a))))
    return a[place < k], r[place < k]


class Search:
    """What the tasks share: the tree, the sample, and the shape of packed vectors."""

    def __init__(self, tree: Tree, dim: int, kind: str, ids, labels, vectors):
        self.tree, self.dim, self.kind = tree, dim, kind
        self.ids, self.labels, self.vectors = ids, labels, vectors

    def scores(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.rint(anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)

    def floors(self, ids, labels, vectors, low, high, k: int, same: bool) -> np.ndarray:
        """(anchor, window): a score that the k-th best row of the window reaches for sure; ``low`` if the sample doesn't tell."""
        score = self.scores(vectors, self.vectors)
        fits = (labels[:, None] == self.labels) == same
        fits &= ids[:, None] != self.ids
        out = low.copy()
        for w in range(low.shape[1]):
            inside = np.where(fits & (score >= low[:, w, None]) & (score <= high[:, w, None]), score, np.iinfo(np.int64).min)
            if inside.shape[1] >= k:
                out[:, w] = np.maximum(out[:, w], np.partition(inside, inside.shape[1] - k, axis=1)[:, inside.shape[1] - k])
        return out

    def annuli(self, vectors, low, high):
        """Inner and outer radius of the scores low..high around the anchors."""
        square = (vectors.astype(np.float64) ** 2).sum(axis=1) + self.tree.square
        return np.sqrt(np.maximum(square - 2 * high.astype(np.float64), 0)), np.sqrt(np.maximum(square - 2 * low.astype(np.float64), 0))


def build(rows: DataFrame, sample: int = SAMPLE, degree: int = DEGREE, leaf: int = LEAF) -> tuple[DataFrame, DataFrame, Search] | None:
    """(rows with their leaf, packed blocks, what a search needs) of ``as_rows`` rows; None without rows."""
    rows = materialise(rows, "vectors")
    largest = F.aggregate("vec", F.lit(0).cast("double"), lambda a, c: a + c.cast("double") * c.cast("double"))
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim"), F.max(largest).alias("square"),
                     F.max(F.array_max(F.transform("vec", lambda c: F.abs(c)))).alias("most")).first()
    if not facts.n:
        return None
    dim, square = max(facts.dim, 1), facts.square or 0.0
    if square >= LARGEST:
        raise ValueError("components are too large for exact scores")
    kind = "<i2" if (facts.most or 0) < 1 << 15 else "<i4" if facts.most < 1 << 31 else "<i8"
    # Bounded by SAMPLE: about that many rows pass the hash threshold, and the smallest hashes stay.
    unit = 1 << 40
    place = F.pmod(F.xxhash64("id"), F.lit(unit))
    held = rows.filter(place < F.lit(2.0 * sample * unit) / F.lit(facts.n)).orderBy(place, "id").limit(sample).toArrow()
    points = _matrix(held.column("vec").combine_chunks(), dim)
    tree = Tree(points, square, degree, leaf)
    search = Search(tree, dim, kind, _numbers(held.column("id")), _numbers(held.column("label")), points)
    bare = share(rows.sparkSession, search)

    def route(batches):
        s = bare()
        for batch in batches:
            x = s.tree.lift(_matrix(batch.column("vec"), s.dim))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s.tree.leaf_of(x))], names=["id", "label", "vec", "leaf"])

    routed = materialise(rows.mapInArrow(route, f"id {rows.schema['id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, "
                                                "vec array<bigint>, leaf long"), "routed")

    def ranges(batches):
        s = bare()
        low = [np.full((len(p), len(p)), np.inf) for p, _ in s.tree.nodes]
        high = [np.full((len(p), len(p)), -np.inf) for p, _ in s.tree.nodes]

        def see(node, d, near):
            for j in np.unique(near):
                part = d[near == j]
                low[node][:, j] = np.minimum(low[node][:, j], part.min(axis=0))
                high[node][:, j] = np.maximum(high[node][:, j], part.max(axis=0))
        for batch in batches:
            s.tree.leaf_of(s.tree.lift(_matrix(batch.column("vec"), s.dim)), see)
        for node, (a, b) in enumerate(zip(low, high)):
            i, j = np.nonzero(np.isfinite(a))
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), node)), pa.array(i), pa.array(j), pa.array(a[i, j]), pa.array(b[i, j])],
                                                 names=["node", "i", "j", "low", "high"])

    # Bounded by the tree: at most DEGREE rows for each split point.
    tree.set_ranges(tuple(r) for r in routed.select("vec").mapInArrow(ranges, "node long, i long, j long, low double, high double")
                    .groupBy("node", "i", "j").agg(F.min("low"), F.max("high")).collect())
    sizes = routed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    spread = routed.join(F.broadcast(sizes), "leaf").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))

    def pack(batches):
        ids, labels, vectors, at = [], [], [], None

        def block():
            v = np.concatenate(vectors).astype(kind)
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                                               pa.array([np.concatenate(labels).tobytes()], pa.binary()), pa.array([v.tobytes()], pa.binary())],
                                              names=["leaf", "ids", "labels", "vectors"])
        held = 0
        for batch in batches:
            leaf, key, label = (_numbers(batch.column(c)) for c in ("leaf", "id", "label"))
            vec = _matrix(batch.column("vec"), dim)
            edges = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
            for a, b in zip(edges, [*edges[1:], len(leaf)]):
                while a < b:
                    if held and (leaf[a] != at or held >= BLOCK):
                        yield block()
                        ids, labels, vectors, held = [], [], [], 0
                    at, to = int(leaf[a]), min(b, a + BLOCK - held)
                    ids.append(key[a:to])
                    labels.append(label[a:to])
                    vectors.append(vec[a:to])
                    held += to - a
                    a = to
        if held:
            yield block()
        give_back()

    blocks = materialise(spread.select("leaf", "part", "id", "label", "vec").repartition("leaf", "part").sortWithinPartitions("leaf", "part", "id")
                         .select("leaf", "id", "label", "vec").mapInArrow(pack, "leaf long, ids binary, labels binary, vectors binary"), "blocks")
    return routed, blocks, search


#: No window has a score below this (scores stay under 2**53).
NEVER = -(1 << 60)
FOUND = "anchor long, id long, against long, against_score long, score long"


def find(anchors: DataFrame, blocks: DataFrame, search: Search, k: int, same: bool) -> DataFrame:
    """The rows of FOUND: for every anchor (id, label, vec, windows: array of (against, against_score, low, high)) and window at least the k best rows with a score from low to
    high, of the anchor's label or (``same`` false) of others. Several blocks may find more than k; see ``top``."""
    held = share(anchors.sparkSession, search)

    def reach(batches):
        s = held()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                ids, labels, vec = _numbers(part.column("id")), _numbers(part.column("label")), _matrix(part.column("vec"), s.dim)
                windows = part.column("windows").to_pylist()
                wide = max(len(w) for w in windows)
                table = np.zeros((len(ids), wide, 4), np.int64)
                table[:, :, 2], table[:, :, 3] = 1, 0  # an empty window
                for i, ws in enumerate(windows):
                    for j, w in enumerate(ws):
                        table[i, j] = w["against"], w["against_score"], w["low"], w["high"]
                floor = s.floors(ids, labels, vec, table[:, :, 2], table[:, :, 3], k, same)
                table[:, :, 2] = floor
                lifted = s.tree.lift(vec, anchor=True)
                who = [set() for _ in range(s.tree.leaves)]
                for w in range(wide):
                    open_ = np.flatnonzero(table[:, w, 2] <= table[:, w, 3])
                    if len(open_):
                        inner, outer = s.annuli(vec[open_], np.maximum(table[open_, w, 2], -int(s.tree.square) - 1), np.minimum(table[open_, w, 3], int(s.tree.square) + 1))
                        for leaf, some in enumerate(s.tree.reached(lifted[open_], inner, outer)):
                            who[leaf].update(open_[some].tolist())
                for leaf, some in enumerate(who):
                    some = np.array(sorted(some), np.int64)
                    for a in range(0, len(some), CHUNK):
                        c = some[a:a + CHUNK]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([leaf], pa.int64()), pa.array([ids[c].tobytes()], pa.binary()), pa.array([labels[c].tobytes()], pa.binary()),
                             pa.array([vec[c].astype(s.kind).tobytes()], pa.binary()), pa.array([table[c].tobytes()], pa.binary())],
                            names=["leaf", "a_ids", "a_labels", "a_vectors", "a_windows"])

    def score(batches):
        s = held()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                ids, labels = _unpack(row["ids"]), _unpack(row["labels"])
                a_ids, a_labels, table = _unpack(row["a_ids"]), _unpack(row["a_labels"]), _unpack(row["a_windows"])
                table = table.reshape(len(a_ids), -1, 4)
                points = s.scores(_unpack(row["a_vectors"], s.kind, s.dim), _unpack(row["vectors"], s.kind, s.dim))
                fits = ((a_labels[:, None] == labels) == same) & (a_ids[:, None] != ids)
                for w in range(table.shape[1]):
                    inside = fits & (points >= table[:, w, 2, None]) & (points <= table[:, w, 3, None])
                    if inside.any():
                        a, r = _best(*np.nonzero(inside), points, ids, k)
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (a_ids[a], ids[r], table[a, w, 0], table[a, w, 1], points[a, r])],
                                                         names=["anchor", "id", "against", "against_score", "score"])

    chunks = materialise(anchors.select("id", "label", "vec", "windows").mapInArrow(reach, "leaf long, a_ids binary, a_labels binary, a_vectors binary, a_windows binary"), "reached")
    # Never broadcast: a chunk that goes to many leaves looks small in its compressed file.
    return chunks.hint("merge").join(blocks, "leaf").drop("leaf").mapInArrow(score, FOUND)


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best of every anchor and window, with their rank; Spark limits each task's share before it shuffles."""
    order = Window.partitionBy("anchor", "against").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         sample: int = SAMPLE, degree: int = DEGREE, leaf: int = LEAF) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of ``as_rows``; ``is_anchor`` is a condition over id,
    label and vec."""
    spark = rows.sparkSession
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    made = build(rows, sample, degree, leaf)
    if made is None:
        return spark.createDataFrame([], out)
    routed, blocks, search = made
    anchors = routed.filter(is_anchor).select("id", "label", "vec")
    all_scores = F.array(F.struct(*[F.lit(v).cast("long").alias(n) for n, v in (("against", 0), ("against_score", 0), ("low", NEVER), ("high", -NEVER))]))
    near = materialise(top(find(anchors.withColumn("windows", all_scores), blocks, search, positives, same=True), positives), "positives")
    p = F.col("score")
    exact = F.expr(f"CASE WHEN score >= 0 THEN (score * {low} + 99) div 100 ELSE -((-score * {low}) div 100) END")
    upper = F.expr(f"CASE WHEN score >= 0 THEN (score * {high}) div 100 ELSE -((-score * {high} + 99) div 100) END")
    window = F.struct(F.col("id").alias("against"), p.alias("against_score"), exact.alias("low"), upper.alias("high"))
    # At most ``positives`` windows for an anchor.
    wanted = near.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(window).alias("windows"))
    found = top(find(anchors.join(wanted, "id"), blocks, search, negatives, same=False), negatives)
    return found.select(F.col("anchor").cast("long").alias("anchor_id"), F.col("against").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                        F.col("id").alias("negative_id"), F.col("against_score").alias("positive_score"), F.col("score").alias("negative_score"))
