"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans (``base_spans``). The field labels words as the beginning or inside of a kind or as
other; its features are hashed shapes of a word and its neighbours and the words before it, so it also finds data that the patterns
miss: addresses with a written "at" or blanks, numbers without a plus or in other groups, and secrets (tokens and keys), a kind of its own.

It is trained on a small labelled table (``labelled_words``: at most ``TRAIN_DOCUMENTS`` documents, and of them at
most ``TRAIN_SEQUENCES`` sequences). Its labels come from the patterns, from the same data rewritten into forms that the patterns do
not take (``rewritten``), and from assignments of long values to names like token or password (``secret_spans``). Decoding is
Viterbi over numpy batches. A word can only be labelled near a word with a digit or an @ (or a written one); sequences are the
stretches of at most ``REACH`` words around those. Base spans always stay; the field adds spans that overlap no base span
and hold what their kind needs (``plausible``).

Defined results: null is empty and has no spans; positions count code points, ends are exclusive; without any
labelled sequence the field adds nothing; every row, repeated or not, gives one row.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import bounded_sample, free_name, materialise, share
from lakeledger.llm.ngrams import slices

KINDS = ("email", "ip", "card", "phone")
#: The field knows one kind more than the patterns.
ALL_KINDS = (*KINDS, "secret")
LABELS = ["O", *[f"{p}-{k}" for k in ALL_KINDS for p in "BI"]]
TRAIN_DOCUMENTS = 8000
TRAIN_SEQUENCES = 3000
REACH = 2
BUCKETS = 1 << 13
PADDED = 60_000

_TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]")
_WRITTEN_AT = re.compile(r"@|[(\[]at[)\]]")
_SECRET = re.compile(r"(?i)\b(?:token|secret|passwd|password|pwd|api[ _-]?key|access[ _-]?key)\b[\x20]{0,3}[=:][\x20]{0,3}[\"']?([A-Za-z0-9+/_.=-]{12,})")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    doubled = [int(d) for d in digits[::-1]]
    return (sum(doubled[::2]) + sum((2 * d) // 10 + (2 * d) % 10 for d in doubled[1::2])) % 10 == 0


def _emails(text: str):
    """Leftmost matches, found from each @ outwards, so that long words cost no more than their length."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = max(free, at)
        at = text.find("@", max(at + 1, free))


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the pattern matches, by kind and start."""
    if not text or not _TRIGGER.search(text):
        return []
    spans = [(0, a, b) for a, b in _emails(text)]
    spans += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    spans += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    spans += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return spans


def secret_spans(text: str) -> list[tuple[int, int, int]]:
    """Values that a name like token or password is given; only the labelled table uses them."""
    return [(4, m.start(1), m.end(1)) for m in _SECRET.finditer(text) if secret_like(m[1])]


def secret_like(piece: str) -> bool:
    return len(piece) >= 12 and not any(c.isspace() for c in piece) and any(c.isdigit() for c in piece) and any(c.isalpha() for c in piece)


def rewritten(kind: int, piece: str) -> list[str]:
    """A pattern's match in forms that the patterns do not take."""
    if kind == 0:
        local, domain = piece.rsplit("@", 1)
        return [f"{local} (at) {domain}", f"{local}[at]{domain}", f"{local} @ {domain}"]
    if kind == 1:
        return [piece.replace(".", "[.]"), piece.replace(".", " . ")]
    d = _digits(piece)
    if kind == 2:
        groups = [d[i:i + 4] for i in range(0, len(d), 4)]
        return [".".join(groups), "/".join(groups), " - ".join(groups)]
    own = d[2:]
    return [f"00{d[:2]} {own[:3]} {own[3:]}", f"(0{own[:2]}) {own[2:5]} {own[5:]}", f"0{own[:3]}/{own[3:]}", f"0{own[:3]}-{own[3:6]}-{own[6:]}"]


def as_text(spans) -> str:
    return ",".join(f"{ALL_KINDS[k]}:{a}:{b}" for k, a, b in spans)


# --- words, shapes, sequences ----------------------------------------------------


def sequences(text: str) -> list[list[tuple[int, int]]]:
    """Stretches of words (start, end) that stand within REACH words of a word with a digit or @."""
    if not _TRIGGER.search(text):
        return []
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = np.array([w[0] for w in words])
    marks = np.unique(np.searchsorted(starts, [m.start() for m in _TRIGGER.finditer(text)], "right") - 1)
    near = np.unique((marks[:, None] + np.arange(-REACH, REACH + 1)).ravel())
    near = near[(near >= 0) & (near < len(words))]
    return [[words[i] for i in part] for part in np.split(near, np.flatnonzero(np.diff(near) > 1) + 1)]


def shape(word: str) -> str:
    """Runs of one class as the class and how many: up to 4 as such, then by ranges."""
    out, last, n = [], "", 0
    for c in word[:64] + "\0":
        kind = "d" if "0" <= c <= "9" else "A" if c.isupper() else "a" if c.isalpha() else c
        if kind != last:
            if last:
                out.append(last + (str(n) if n < 5 else "5" if n < 9 else "9" if n < 13 else "M"))
            last, n = kind, 0
        n += 1
    return "".join(out)


def _bucket(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode(), digest_size=4).digest(), "little") % BUCKETS


class Features:
    """Feature buckets of a word among its neighbours; shapes are remembered."""

    def __init__(self):
        self.shapes: dict[str, tuple] = {}
        self.buckets: dict[tuple, int] = {}

    def facts(self, word: str) -> tuple:
        s = shape(word)
        digits = len(_digits(word))
        runs = re.sub(r"[0-9M]", "", s)
        mixture = min(len(word) // 6, 6), min(len(runs) // 4, 6)
        name = word.lower().strip(":=\"'.,") if len(word) <= 12 else ""
        return s, runs[:12], word[0], word[-1] if not word[-1].isalnum() else "x", min(digits, 20), "@" in word, min(word.count("."), 4), mixture, name if name.isalpha() else ""

    def bucket(self, key: tuple) -> int:
        known = self.buckets.get(key)
        if known is None:
            if len(self.buckets) > 100_000:
                self.buckets.clear()
            known = self.buckets[key] = _bucket(*key)
        return known

    def of(self, words: list[str]) -> list[list[int]]:
        facts = [None, *[self.facts(w) for w in words], None]
        out = []
        for i in range(1, len(facts) - 1):
            f, before, after = facts[i], facts[i - 1], facts[i + 1]
            earlier = facts[i - 2] if i > 1 else None
            keys = [("s", f[0]), ("c", f[1]), ("a", f[2] if not f[2].isalpha() else "x"), ("z", f[3]), ("n", f[4]), ("@", f[5]), (".", f[6]),
                    ("b", before and before[1]), ("f", after and after[1]), ("bn", before and before[4], f[4]), ("fn", after and after[4], f[4]),
                    ("m", f[7]), ("w", before and before[8]), ("ww", earlier and earlier[8], before and before[1])]
            out.append([self.bucket(k) for k in keys])
        return out


def beside(parts: list[list[tuple[int, int]]], spans):
    """Each sequence with the spans that meet it; both are walked once, in order of start."""
    waiting, near = sorted(spans, key=lambda s: s[1])[::-1], []
    for words in parts:
        near = [s for s in near if s[2] > words[0][0]]
        while waiting and waiting[-1][1] < words[-1][1]:
            near.append(waiting.pop())
        yield words, [s for s in near if s[2] > words[0][0]]


class Covered:
    """Places that spans cover, for spans that are asked for (and added) in order of start."""

    def __init__(self, spans):
        self.waiting, self.end = sorted(((a, b) for _, a, b in spans), reverse=True), 0

    def add(self, a: int, b: int) -> bool:
        """Whether [a, b) is free; it is covered from then on. ``a`` never falls."""
        while self.waiting and self.waiting[-1][0] <= a:
            self.end = max(self.end, self.waiting.pop()[1])
        if a < self.end or self.waiting and self.waiting[-1][0] < b:
            return False
        self.end = b
        return True


def gold(words: list[tuple[int, int]], spans) -> list[int]:
    """Label numbers of words, given spans."""
    labels = [0] * len(words)
    for k, a, b in sorted(spans, key=lambda s: s[1]):
        first = True
        for i, (s, e) in enumerate(words):
            if s < b and e > a:
                if labels[i] == 0:
                    labels[i] = 1 + 2 * k + (not first)
                first = False
    return labels


# --- the field ----------------------------------------------------------------------


class Field:
    """Emission weights (bucket by label), transitions and start weights."""

    def __init__(self, emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.emit, self.move, self.start = emit, move, start

    def viterbi(self, batch: list[list[list[int]]]) -> list[np.ndarray]:
        """Best labels of each sequence; sequences are padded together, short with short."""
        out: list = [None] * len(batch)
        order = sorted(range(len(batch)), key=lambda i: len(batch[i]))
        i = 0
        while i < len(order):
            j = i + 1
            while j < len(order) and (j + 1 - i) * len(batch[order[j]]) <= PADDED:
                j += 1
            group = [batch[k] for k in order[i:j]]
            lengths = np.array([len(g) for g in group])
            longest = lengths.max()
            score = np.zeros((len(group), longest, len(LABELS)), np.float32)
            row = np.repeat(np.arange(len(group)), lengths)
            place = np.concatenate([np.arange(n) for n in lengths])
            score[row, place] = self.emit[np.array([f for g in group for f in g])].sum(axis=1)
            best = score[:, 0] + self.start
            back = np.zeros((longest, len(group), len(LABELS)), np.int8)
            for t in range(1, longest):
                step = best[:, :, None] + self.move
                back[t] = step.argmax(axis=1)
                new = step.max(axis=1) + score[:, t]
                best = np.where((t < lengths)[:, None], new, best)
            for r, k in enumerate(order[i:j]):
                path = [int(best[r].argmax())]
                for t in range(lengths[r] - 1, 0, -1):
                    path.append(int(back[t, r, path[-1]]))
                out[k] = np.array(path[::-1])
            i = j
        return out


def fit(batch: list[list[list[int]]], labels: list[list[int]], rounds: int = 80, ridge: float = 0.1, rate: float = 0.3) -> Field:
    """Maximum conditional likelihood with an L2 penalty: forward-backward over a padded batch, adaptive gradient steps."""
    n_labels, lengths = len(LABELS), np.array([len(b) for b in batch])
    longest, width = lengths.max(), len(batch[0][0])
    feats = np.zeros((len(batch), longest, width), np.int64)
    truth = np.zeros((len(batch), longest), np.int64)
    inside = np.arange(longest) < lengths[:, None]
    feats[inside] = np.array([f for b in batch for f in b])
    truth[inside] = np.concatenate([np.array(x) for x in labels])
    emit, move, start = np.zeros((BUCKETS, n_labels)), np.zeros((n_labels, n_labels)), np.zeros(n_labels)
    flat, hot = feats[inside].ravel(), np.eye(n_labels)
    steps = [np.full(p.shape, 1e-6) for p in (emit, move, start)]
    total = len(batch)
    for _ in range(rounds):
        score = emit[feats].sum(axis=2)
        alpha, beta = np.zeros(score.shape), np.zeros(score.shape)
        alpha[:, 0] = start + score[:, 0]
        for t in range(1, longest):
            a = alpha[:, t - 1, :, None] + move
            top = a.max(axis=1)
            new = np.log(np.exp(a - top[:, None]).sum(axis=1)) + top + score[:, t]
            alpha[:, t] = np.where(inside[:, t, None], new, alpha[:, t - 1])
        final = alpha[:, -1]
        log_z = np.log(np.exp(final - final.max(1, keepdims=True)).sum(1)) + final.max(1)
        pair = np.zeros((n_labels, n_labels))
        for t in range(longest - 2, -1, -1):
            b = move + (score[:, t + 1] + beta[:, t + 1])[:, None, :]
            top = b.max(axis=2)
            new = np.log(np.exp(b - top[:, :, None]).sum(axis=2)) + top
            live = inside[:, t + 1]
            beta[:, t] = np.where(live[:, None], new, 0)
            p = np.exp(alpha[:, t, :, None] + b - log_z[:, None, None])
            pair += (p * live[:, None, None]).sum(axis=0)
            pair -= (hot[truth[:, t]][:, :, None] * hot[truth[:, t + 1]][:, None, :] * live[:, None, None]).sum(axis=0)
        marginal = np.exp(alpha + beta - log_z[:, None, None])
        # Where a sequence has ended alpha repeats its last value; only places inside count.
        error = (marginal - hot[truth])[inside]
        g_emit = np.stack([np.bincount(flat, weights=np.repeat(error[:, k], width), minlength=BUCKETS) for k in range(n_labels)], 1)
        grads = [g_emit / total + ridge / total * emit, pair / total + ridge / total * move, (marginal[:, 0] - hot[truth[:, 0]]).sum(axis=0) / total]
        for p, g, s in zip((emit, move, start), grads, steps):
            s += g * g
            p -= rate * g / np.sqrt(s)
    return Field(emit.astype(np.float32), move.astype(np.float32), start.astype(np.float32))


#: Code points of context that a rewritten form keeps on each side.
CONTEXT = 60


def other_forms(text: str, span: tuple[int, int, int]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """A span's surroundings with the span in other forms, each with its spans."""
    kind, a, b = span
    left, right = text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]
    out = []
    for form in rewritten(kind, text[a:b]):
        t = f"{left}{form}{right}"
        own = (kind, len(left), len(left) + len(form))
        out.append((t, [own] + [s for s in base_spans(t) + secret_spans(t) if s[2] <= own[1] or s[1] >= own[2]]))
    return out


def labelled_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_documents: int = TRAIN_DOCUMENTS, n_sequences: int = TRAIN_SEQUENCES) -> DataFrame:
    """The small labelled table: (place, words, labels), at most ``n_sequences`` rows, by the hash of their words."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    ids = rows.filter("id IS NOT NULL").select("id", F.lit(0).alias("all"))
    chosen = materialise(bounded_sample(ids, n_documents, "all", "id").select("id").distinct(), "pii-sample")

    def run(batches):
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                spans = base_spans(text)
                given = [(text, spans + secret_spans(text))] + [c for s in spans for c in other_forms(text, s)]
                out = [(hashlib.md5(" ".join(words).encode()).hexdigest(), words, gold(seq, near))
                       for t, s in given for seq, near in beside(sequences(t), s) if len(seq) <= 60 for words in ([t[a:b] for a, b in seq],)]
                if out:
                    a, b, c = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.list_(pa.string())), pa.array(c, pa.list_(pa.int32()))], names=["place", "words", "labels"])

    found = rows.join(F.broadcast(chosen), "id", "left_semi").select("text").mapInArrow(run, "place string, words array<string>, labels array<int>")
    return found.dropDuplicates(["place"]).orderBy("place").limit(n_sequences)


def train(labelled: DataFrame) -> Field | None:
    rows = labelled.collect()
    if not rows:
        return None
    features = Features()
    return fit([features.of(list(r["words"])) for r in rows], [list(r["labels"]) for r in rows])


#: What a span that the field adds must hold.
def plausible(kind: int, piece: str) -> bool:
    n = len(_digits(piece))
    if kind == 0:
        at = _WRITTEN_AT.search(piece, 1)
        return at is not None and "." in piece[at.end():].strip()[1:-1]
    if kind == 1:
        parts = re.findall("[0-9]+", piece)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and not any(c.isalpha() for c in piece)
    if kind == 2:
        return 13 <= n <= 19 and luhn(_digits(piece)) and not any(c.isalpha() for c in piece)
    if kind == 3:
        return 9 <= n <= 15 and piece[0] in "+(0" and not any(c.isalpha() for c in piece)
    return secret_like(piece)


def field_spans(text: str, words, labels) -> list[tuple[int, int, int]]:
    out, i = [], 0
    while i < len(words):
        if labels[i] == 0:
            i += 1
            continue
        kind, j = (labels[i] - 1) // 2, i + 1
        while j < len(words) and labels[j] == 2 + 2 * kind:
            j += 1
        a, b = words[i][0], words[j - 1][1]
        while a < b and not (text[a].isalnum() or text[a] in "+("):
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        if plausible(int(kind), text[a:b]):
            out.append((int(kind), a, b))
        i = j
    return out


def spans_of(texts: list[str], features: Features, model: Field | None) -> tuple[list, list]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    owners, words, feats = [], [], []
    for i, t in enumerate(texts):
        for seq in sequences(t) if model else ():
            owners.append(i)
            words.append(seq)
            feats.append(features.of([t[a:b] for a, b in seq]))
    every, covered = [list(b) for b in base], [Covered(b) for b in base]
    for i, seq, labels in zip(owners, words, model.viterbi(feats) if feats else ()):
        if labels.any():
            for k, a, b in field_spans(texts[i], seq, labels):
                if covered[i].add(a, b):
                    every[i].append((k, a, b))
    return base, every


def find(docs: DataFrame, field: Field | None, text_col: str = "text") -> DataFrame:
    """``docs`` (all columns) with counts of base spans (n_email, n_ip, n_card, n_phone), base (spans as text) and spans (all spans as text)."""
    shared = share(docs.sparkSession, field)

    def run(batches):
        features, model = Features(), shared()
        for batch in batches:
            base, every = spans_of([t.as_py() or "" for t in batch.column(batch.num_columns - 1)], features, model)
            counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counts, pa.array([as_text(b) for b in base]), pa.array([as_text(sorted(e)) for e in every])],
                                             names=[*batch.schema.names[:-1], "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    made = ("n_email", "n_ip", "n_card", "n_phone", "base", "spans")
    rows = docs.select(*[c for c in docs.columns if c not in made], F.col(text_col).alias(free_name(docs.columns)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, schema + ", n_email long, n_ip long, n_card long, n_phone long, base string, spans string")


def redact(docs: DataFrame, field: Field | None, text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets (overlapping spans by the kind that begins first);
    null texts stay null. Spans are found and replaced by one function, so a task has one worker process, which
    holds the words of one slice of texts at a time."""
    shared, place = share(docs.sparkSession, field), docs.columns.index(text_col)

    def replaced(text, spans):
        out, at = [], 0
        for a, b, kind in sorted((a, b, ALL_KINDS[k]) for k, a, b in spans):
            if a >= at:
                out += [text[at:a], f"[{kind.upper()}]"]
            at = max(at, b)
        return "".join([*out, text[at:]]) if spans else text

    def run(batches):
        features, model = Features(), shared()
        for batch in batches:
            for at, texts in slices(batch.column(place)):
                _, every = spans_of([t or "" for t in texts], features, model)
                columns = batch.slice(at, len(texts)).columns
                columns[place] = pa.array([replaced(t, s) for t, s in zip(texts, every)], pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields))
