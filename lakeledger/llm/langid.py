"""Language identification in two steps: first the family, then the language inside it.

Features are relative frequencies of hashed character n-grams (1 to 3 bytes, lower case) in ``BUCKETS`` buckets. Linear
support vector machines (squared hinge loss) separate families one against the rest; inside a family every pair of languages has
its own machine, and the language with the most won pairs is taken (ties: the larger sum of margins). The
training sample is bounded: at most ``PER_LANGUAGE`` documents of each language, those with the smallest hashes
of their ids; each also takes part with a short passage, so that short texts are known too.

Defined results: null texts and texts without letters are ``und`` with score 0; without training rows
everything is ``und``; a language that ``families`` does not name is its own family; every row, repeated or
not, gives one row; languages are learned only from rows that have one.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import bounded_sample, free_name, materialise, share
from lakeledger.llm.ngrams import grams, lowered, slices

PER_LANGUAGE = 500
#: Rows of all languages together that the machines are fitted on (16 KB each on the driver).
MOST_ROWS = 8000
BUCKETS = 4096
SIZES = (1, 2, 3)
PASSAGE = 100
UNKNOWN = "und"
#: Families of common language codes.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es pt it ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv", "uralic": "fi et hu", "celtic": "ga gd cy br",
    "indo-aryan": "hi bn mr pa gu ne ur si", "iranian": "fa ku ps", "turkic": "tr az kk ky uz tk tt",
    "semitic": "ar he am mt", "dravidian": "ta te kn ml", "sinitic": "zh", "japonic": "ja", "koreanic": "ko",
    "austronesian": "id ms tl jv", "tai": "th lo", "austroasiatic": "vi km", "hellenic": "el", "armenian": "hy", "kartvelian": "ka",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = re.compile("[A-Za-z]")


def has_letters(text: str | None) -> bool:
    return bool(text) and (bool(_LETTER.search(text)) or any(c.isalpha() for c in text))


def _sums(texts, table: np.ndarray, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the sum of table rows over its n-grams of every size, and their number."""
    data, row = lowered(texts)
    total, count = np.zeros((len(texts), table.shape[1])), np.zeros(len(texts))
    for k, n in enumerate(sizes):
        h, r = grams(data, row, n)
        if not len(h):
            continue
        picked = table[(h % np.uint64(BUCKETS)).astype(np.int64)]
        begin = np.flatnonzero(np.append(True, np.diff(r) != 0))
        total[r[begin]] += np.add.reduceat(picked, begin, axis=0)
        count += np.bincount(r, minlength=len(texts))
    return total, count


def frequencies(texts, sizes=SIZES) -> np.ndarray:
    """Relative frequencies of the buckets, a row per text."""
    data, row = lowered(texts)
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for n in sizes:
        h, r = grams(data, row, n)
        out += np.bincount(r * BUCKETS + (h % np.uint64(BUCKETS)).astype(np.int64), minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def machine(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 200) -> np.ndarray:
    """Weights (bias last) of a linear machine for labels +1 and -1, squared hinge loss; both sides weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype)
    v = np.ones(x.shape[1], x.dtype)
    for _ in range(10):  # the largest curvature
        v = x.T @ (weight * (x @ v))
        v /= np.linalg.norm(v) + 1e-12
    step = 1 / (2 * np.linalg.norm(x.T @ (weight * (x @ v))) + ridge + 1e-9)
    w, velocity = np.zeros(x.shape[1], x.dtype), np.zeros(x.shape[1], x.dtype)
    for k in range(rounds):
        at = w + np.float32(k / (k + 3)) * velocity
        slack = np.maximum(0, 1 - y * (x @ at))
        grad = -2 * (x.T @ (weight * y * slack)) + ridge * at
        new = at - np.float32(step) * grad
        velocity, w = new - w, new
    return w


class Model:
    """Machines as columns of one table: a text's margins are one mean of table rows plus a bias."""

    def __init__(self, languages: list[str], families: dict[str, str], x: np.ndarray | None = None, language: np.ndarray | None = None):
        self.languages = sorted(languages)
        self.families = sorted({families.get(c, c) for c in self.languages})
        self.members = {f: [c for c in self.languages if families.get(c, c) == f] for f in self.families}
        self.pairs = [p for f in self.families for p in itertools.combinations(self.members[f], 2)]
        columns = []
        if x is not None and len(self.languages) > 1:
            center, spread = x.mean(axis=0), x.std(axis=0) + 1e-4
            z = (x - center) / spread
            family = np.array([families.get(c, c) for c in language])
            tasks = [(z, np.where(family == f, 1, -1)) for f in self.families] if len(self.families) > 1 else []
            for a, b in self.pairs:
                both = (language == a) | (language == b)
                tasks.append((z[both], np.where(language[both] == a, 1, -1)))
            for part, y in tasks:
                w = machine(part.astype(np.float32), y.astype(np.float32))
                columns.append((w[:-1] / spread, w[-1] - (w[:-1] / spread) @ center))
        self.table = np.stack([c[0] for c in columns], 1).astype(np.float32) if columns else np.zeros((BUCKETS, 0), np.float32)
        self.bias = np.array([c[1] for c in columns])

    def predict(self, texts) -> tuple[list[str], np.ndarray]:
        total, count = _sums(texts, self.table, SIZES)
        margin = total / np.maximum(count, 1)[:, None] + self.bias
        n_family = len(self.families) if len(self.families) > 1 and len(self.bias) else 0
        labels, scores = [], np.zeros(len(texts))
        sure = 1 / (1 + np.exp(-np.clip(4 * margin, -30, 30)))
        for i, text in enumerate(texts):
            if not self.languages or not has_letters(text):
                labels.append(UNKNOWN)
                continue
            best = int(np.argmax(margin[i, :n_family])) if n_family else 0
            score = sure[i, best] if n_family else 1.0
            members = self.members[self.families[best]]
            won = {c: [0, 0.0] for c in members}
            sides = {}
            for k, (a, b) in enumerate(self.pairs):
                if a in won:
                    m, p = margin[i, n_family + k], sure[i, n_family + k]
                    won[a if m >= 0 else b][0] += 1
                    won[a][1] += m
                    won[b][1] -= m
                    sides[a, b], sides[b, a] = p, 1 - p
            top = max(members, key=lambda c: (won[c][0], won[c][1]))
            labels.append(top)
            scores[i] = score * min([sides[top, c] for c in members if c != top], default=1.0)
        return labels, scores


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", where: Column | None = None,
          families: dict[str, str] = _FAMILY_OF, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on the bounded sample of ``docs`` (rows that pass ``where``)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), (F.lit(True) if where is None else where).alias("use"))
    ids = rows.filter("use AND lang IS NOT NULL AND text IS NOT NULL").select("id", "lang").distinct()
    # Many languages share the rows that the driver can hold.
    per_language = max(1, min(per_language, MOST_ROWS // max(1, ids.select("lang").distinct().count())))
    chosen = materialise(bounded_sample(ids, per_language, "lang", "id").withColumn("place", F.pmod(F.xxhash64("id"), F.lit(1 << 40))), "language-sample")
    # Of several texts with one id and language the smallest is learnt from.
    texts = rows.filter("use").join(F.broadcast(chosen), ["id", "lang"]).groupBy("id", "lang").agg(F.min("place").alias("place"), F.min("text").alias("text")).select("lang", "place", "text")

    def run(batches):
        for batch in batches:
            lang, place = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at, part in slices(batch.column(2)):
                for i in range(0, len(part), 64):
                    some = part[i:i + 64]
                    short = [(t or "")[len(t or "") // 3:][:PASSAGE] for t in some]
                    for kind, given in enumerate((some, short)):
                        x = frequencies(given).astype(np.float16)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(lang[at + i:at + i + len(some)]), pa.array([2 * p + kind for p in place[at + i:at + i + len(some)]], pa.int64()),
                             pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "place", "x"])

    found = texts.mapInArrow(run, "lang string, place long, x binary").orderBy("lang", "place").toArrow()
    if not found.num_rows:
        return Model([], families)
    x = np.stack([np.frombuffer(v.as_py(), np.float16) for v in found["x"]]).astype(np.float32)
    language = np.array(found["lang"].to_pylist())
    return Model(sorted(set(language)), families, x, language)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with lang_pred and score."""
    shared = share(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            labels, scores = [], [np.empty(0)]
            for _, texts in slices(batch.column(batch.num_columns - 1)):
                a, b = shared().predict(texts)
                labels += a
                scores.append(b)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(labels, pa.string()), pa.array(np.concatenate(scores))],
                                             names=[*batch.schema.names[:-1], "lang_pred", "score"])

    rest = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    rows = docs.select(*rest, F.col(text_col).alias(free_name(docs.columns)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, lang_pred string, score double")
