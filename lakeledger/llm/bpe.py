"""Byte-pair encoding by backtracking, and decoding.

Merges are exact and take linear time: an Aho-Corasick automaton over the vocabulary, read from
the end of a word, gives the longest token at every place; a token is taken when it is compatible with
the token before it (merging their concatenation would leave just these two; answers are kept in a
table), else the next shorter token is tried, and with none left the last token is taken back.
A place that was given up is marked, so no place is tried twice. The words of a slice that are
not known yet go through this side by side in numpy, each with its own place and its own taken tokens;
long words go alone.

Decoding reads tokens from one string by an offset table and joins them as a tokenizer without a
decoder does: by one space.

The vocabulary is a tokenizers file (path is a parameter) of the word-end kind: NFC, lower
case, words by a pattern, bytes as printable characters, ``</w>`` behind a word. Its size is checked
before it is broadcast (``LARGEST_VOCABULARY`` bytes of JSON).

Defined results: null is empty; an empty text has no tokens (and decodes to the empty string);
special tokens standing in a text become their ids, as in the library; every row, repeated or not,
gives one row; other columns are dropped unless named in ``keep``.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.common import SLICE_BYTES, free_name, share

LARGEST_VOCABULARY = 32 << 20
#: Words held by a worker; when it is full, the table keeps those of the slice at hand.
WORD_TABLE = 150_000
#: Pairs whose compatibility a worker remembers (a power of two; a new pair takes the place of the old one in its slot).
PAIR_TABLE = 1 << 20
#: Words of more bytes are encoded alone, and longer ones than this many characters are not held.
LONG_WORD = 64
LONGEST_HELD = 100
#: Rows of one output batch.
ROWS = 500
#: One character that stands for the word end inside the automaton, and its code (bytes are 0 to 255).
END = "\x00"
END_CODE = 256


def byte_characters() -> list[str]:
    """The printable character for each byte: itself where it is printable, else one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = iter(range(256, 512))
    return [chr(b) if b in set(shown) else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Tokens in merge order, and what encoding and decoding need of them."""

    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self._ready = False

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("suffix", "vocab", "merges", "special", "pattern")} | {"_ready": False}

    def _inner(self, token: str) -> str:
        return token[:-len(self.suffix)] + END if self.suffix and token.endswith(self.suffix) else token

    def prepare(self) -> "Vocabulary":
        """Tables; built once for each worker process."""
        if self._ready:
            return self
        order = {t: k for k, t in enumerate(t for t in sorted(self.vocab, key=self.vocab.get) if len(self._inner(t).rstrip(END)) == 1)}
        self.left, self.right = list(range(len(order))), list(range(len(order)))
        self.pairs: dict[tuple[int, int], int] = {}
        for a, b in self.merges:
            k = len(self.left)
            order[a + b] = k
            self.left.append(order[a])
            self.right.append(order[b])
            self.pairs[order[a], order[b]] = k
        self.pair_keys = np.full(PAIR_TABLE, -1, np.int64)
        self.pair_answers = np.zeros(PAIR_TABLE, bool)
        self.text = [self._inner(t) for t in order]
        self.ids = [self.vocab[t] for t in order]
        # A token that its own merges would not make never comes out; the automaton leaves it out.
        made = [True] * len(order)
        for k in range(len(order)):
            if self.left[k] != k:
                made[k] = made[self.left[k]] and made[self.right[k]] and self._compatible(self.left[k], self.right[k], k)
        number = {self.text[k]: k for k in range(len(order)) if made[k]}
        self._build_automaton(number)
        self.shorter = [-1] * len(order)
        for t, k in number.items():
            for n in range(len(t) - 1, 0, -1):
                if t[:n] in number:
                    self.shorter[k] = number[t[:n]]
                    break
        # For many words side by side; the last place stands for "no token".
        self.sizes = np.array([*map(len, self.text), 0], np.int32)
        self.shorter_of = np.array([*self.shorter, -1], np.int32)
        self.id_text = [str(i) for i in self.ids]
        self.id_lengths = np.array([len(t) for t in self.id_text])
        self.name_lengths = np.array([len(t) for t in order])
        names = [""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for t, i in [*self.vocab.items(), *self.special.items()]:
            names[i] = t
        self.joined = "".join(names)
        self.offsets = np.concatenate([[0], np.cumsum([len(n) for n in names])]).tolist()
        self.words = regex.compile(self.pattern)
        self.ascii_words = self.words
        if r"\p" not in re.sub(r"\[[^\]]*\]", "", self.pattern):
            plain = self.pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").replace(r"\p{White_Space}", r"\t-\r ")
            if r"\p" not in plain:
                self.ascii_words = re.compile(plain)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        #: (ids as text, count, decoded) of words, and of special tokens by their id.
        self.fixed = {i: (str(i), 1, self.decode([i])) for i in self.special.values()}
        self.known: dict[str | int, tuple[str, int, str]] = dict(self.fixed)
        self._ready = True
        return self

    def _build_automaton(self, number: dict[str, int]) -> None:
        """Aho-Corasick over the reversed tokens: ``follow`` gives the state after a state's row and a code, ``row`` the row
        of a state (that of its suffix link, if no token goes on from it, or only by the code ``only``, to the state
        ``then``), ``longest`` the longest token that begins where the state was reached (-1: none)."""
        codes = {c: b for b, c in enumerate(byte_characters())} | {END: END_CODE}
        whole = {t[::-1]: k for t, k in number.items()}
        heads = sorted({t[:n] for t in whole for n in range(len(t) + 1)}, key=lambda t: (len(t), t))
        place = {t: s for s, t in enumerate(heads)}
        above = np.array([place[t[:-1]] for t in heads])
        code = np.array([0, *(codes[t[-1]] for t in heads[1:])])
        depth = np.array([len(t) for t in heads])
        children = np.bincount(above[1:], minlength=len(heads))
        last_child = np.zeros(len(heads), np.int32)
        last_child[above] = np.arange(len(heads))
        self.only = np.full(len(heads), -1, np.int16)
        self.then = np.zeros(len(heads), np.int32)
        self.row = np.zeros(len(heads), np.int32)
        self.follow = np.zeros((int((children > 0).sum()), END_CODE + 1), np.int32)  # unused rows take no memory
        rows = 1
        self.longest = np.array([whole.get(t, -1) for t in heads], np.int32)
        link = np.zeros(len(heads), np.int64)
        bounds = np.searchsorted(depth, np.arange(depth[-1] + 2))
        for d in range(depth[-1] + 1):
            level = np.arange(bounds[d], bounds[d + 1])
            if d > 1:
                link[level] = self._step(link[above[level]], code[level])
            if d:
                none = level[self.longest[level] < 0]
                self.longest[none] = self.longest[link[none]]
                # a state whose link has a code of its own shares it without a token that goes on, else needs a row
                plain = self.only[link[level]] < 0
                share = (children[level] == 0) | ((children[level] == 1) & plain)
                leaves, nodes = level[share], level[~share]
                self.row[leaves] = self.row[link[leaves]]
                end = children[leaves] == 0
                self.only[leaves] = np.where(end, self.only[link[leaves]], code[last_child[leaves]])
                self.then[leaves] = np.where(end, self.then[link[leaves]], last_child[leaves])
                self.row[nodes] = np.arange(rows, rows + len(nodes))
                rows += len(nodes)
                self.follow[self.row[nodes]] = self.follow[self.row[link[nodes]]]
                own = nodes[self.only[link[nodes]] >= 0]
                self.follow[self.row[own], self.only[link[own]]] = self.then[link[own]]
            if d < depth[-1]:
                below = np.arange(bounds[d + 1], bounds[d + 2])
                below = below[self.only[above[below]] < 0]
                self.follow[self.row[above[below]], code[below]] = below
        self.rows = rows

    def _step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states after states and codes, side by side."""
        return np.where(self.only[state] == code, self.then[state], self.follow[self.row[state], code])

    def _compatible(self, a: int, b: int, below: int | None = None) -> bool:
        """Whether a before b stays as it is: no merge across their border comes before
        the merges that made them (``below``: only merges before that one count at first)."""
        limit = len(self.left) if below is None else below
        while True:
            if self.pairs.get((a, b), limit) < limit:
                return False
            if a > b:
                a, limit, whole = self.right[a], a, self.right[a] == a
                if whole:
                    b, limit, whole = self.left[b], b + 1, self.left[b] == b
                    if whole:
                        return True
            else:
                b, limit, whole = self.left[b], b + 1, self.left[b] == b
                if whole:
                    a, limit, whole = self.right[a], a, self.right[a] == a
                    if whole:
                        return True

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each a before each b stays as it is; new pairs are put into the table."""
        key = a.astype(np.int64) << 20 | b
        slot = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).view(np.int64) & (PAIR_TABLE - 1)
        answer = self.pair_answers[slot]
        new = np.flatnonzero(self.pair_keys[slot] != key)
        if len(new):
            pairs, first, again = np.unique(key[new], return_index=True, return_inverse=True)
            found = np.array([self._compatible(p >> 20, p & 0xFFFFF) for p in pairs.tolist()])
            answer[new] = found[again]
            self.pair_keys[slot[new[first]]] = pairs
            self.pair_answers[slot[new[first]]] = found
        return answer

    def encode_word(self, word: str) -> list[int]:
        """Ids of one word (as matched by the pattern)."""
        return [self.ids[t] for t in self._encode_alone(word)]

    def _encode_alone(self, word: str) -> list[int]:
        """Numbers of the tokens of one word."""
        codes = [*word.encode(), END_CODE] if self.suffix else [*word.encode()]
        row, follow, only, then, longest = self.row, self.follow, self.only, self.then, [-1] * len(codes)
        state = 0
        for i in range(len(codes) - 1, -1, -1):
            state = then[state] if only[state] == codes[i] else follow[row[state], codes[i]]
            longest[i] = state
        longest = self.longest[longest].tolist()
        open_ = [True] * (len(codes) + 1)
        checked: dict[tuple[int, int], bool] = {}
        taken: list[int] = []
        at, token = 0, longest[0]
        while at < len(codes):
            while True:
                end = at + len(self.text[token]) if token >= 0 else at
                if token >= 0 and open_[end]:
                    pair = (taken[-1], token) if taken else None
                    if pair and pair not in checked:
                        checked[pair] = self._compatible(*pair)
                    if not pair or checked[pair]:
                        taken.append(token)
                        at = end
                        token = longest[at] if at < len(codes) else -1
                        break
                if token >= 0 and self.shorter[token] >= 0:
                    token = self.shorter[token]
                    continue
                open_[at] = False
                token = taken.pop()
                at -= len(self.text[token])
                # the token taken back is not compatible any more: its end is closed
                break
        return taken

    def _encode_together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the tokens of many short words, one word after the other, and how many each word has."""
        tail = END if self.suffix else ""
        data = np.frombuffer((tail.join(words) + tail).encode(), np.uint8)
        size = np.array([len(w.encode()) for w in words]) + len(tail)
        stop = np.cumsum(size)
        start = stop - size
        codes = data.astype(np.int16)
        if tail:
            codes[stop - 1] = END_CODE
        # the automaton, from the last code of each word to its first
        longest = np.empty(len(codes), np.int32)
        order = np.argsort(-size, kind="stable")
        last = stop[order] - 1
        reach = np.searchsorted(-size[order], -np.arange(size.max()), "left")
        state = np.zeros(len(words), np.int32)
        for back, n in enumerate(reach.tolist()):
            at = last[:n] - back
            state = self._step(state[:n], codes[at])
            longest[at] = self.longest[state]
        # backtracking; a step tries one token of each word that is not done
        taken = np.empty(len(codes), np.int32)
        top = start.copy()
        open_ = np.ones(len(codes) + 1, bool)
        live, at, token = np.arange(len(words)), start.copy(), longest[start]
        while len(live):
            end = at + self.sizes[token]
            good = (token >= 0) & open_[end]
            pairs = np.flatnonzero(good & (top[live] > start[live]))
            good[pairs] = self.compatible(taken[top[live[pairs]] - 1], token[pairs])
            hit, miss = np.flatnonzero(good), np.flatnonzero(~good)
            w = live[hit]
            taken[top[w]] = token[hit]
            top[w] += 1
            at[hit] = end[hit]
            done = hit[end[hit] == stop[w]]
            token[hit] = longest[np.minimum(end[hit], stop[w] - 1)]
            token[miss] = self.shorter_of[token[miss]]
            back = miss[token[miss] < 0]
            if len(back):
                w = live[back]
                if (top[w] == start[w]).any():
                    raise ValueError("a byte that is no token of the vocabulary")
                open_[at[back]] = False
                top[w] -= 1
                token[back] = taken[top[w]]
                at[back] -= self.sizes[token[back]]
            if len(done):
                rest = np.ones(len(live), bool)
                rest[done] = False
                live, at, token = live[rest], at[rest], token[rest]
        count = top - start
        return taken[np.arange(count.sum()) + np.repeat(start - (np.cumsum(count) - count), count)], count

    def decode(self, ids) -> str:
        return " ".join([self.joined[self.offsets[i]:self.offsets[i + 1]] for i in ids])

    def learn(self, words: set[str]) -> None:
        """Put entries of words into the table."""
        known, ids, id_text = self.known, self.ids, self.id_text
        short = []
        for w in words:
            if len(w) <= LONG_WORD // 4 or len(w.encode()) <= LONG_WORD:
                short.append(w)
            else:
                t = self._encode_alone(w)
                known[w] = " ".join([id_text[k] for k in t]), len(t), self.decode([ids[k] for k in t])
        if short:
            tokens, count = self._encode_together(short)
            last = np.cumsum(count) - 1
            # all ids as one string, all names as another, cut where words end
            ids_end, names_end = (np.cumsum(length[tokens] + 1)[last].tolist() for length in (self.id_lengths, self.name_lengths))
            tokens = tokens.tolist()
            all_ids, all_names = " ".join([id_text[k] for k in tokens]), self.decode([ids[k] for k in tokens])
            a = c = 0
            for w, n, b, d in zip(short, count.tolist(), ids_end, names_end):
                known[w] = all_ids[a:b - 1], n, all_names[c:d - 1]
                a, c = b, d

    def entries_of(self, texts: list[str]):
        """For each text the entries of all its words and special tokens, in order."""
        found = [self.split(t) for t in texts]
        words = set().union(*found)
        new = words.difference(self.known)
        if len(self.known) + len(new) > WORD_TABLE:
            self.known = self.fixed | {w: self.known[w] for w in words if w in self.known}
        self.learn(new)
        known = self.known
        for words_of_text in found:
            yield [known[w] for w in words_of_text]
        for w in new:
            if len(w) > LONGEST_HELD:
                del known[w]

    def entries(self, text: str) -> list[tuple[str, int, str]]:
        """Entries of all words and special tokens of a text, in order."""
        return [*self.entries_of([text])][0]

    def split(self, text: str) -> list[str | int]:
        """Words, and ids of the special tokens, in order."""
        out, at = [], 0
        for m in self.specials.finditer(text) if self.specials else ():
            out += self._plain(text[at:m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self._plain(text[at:]) if at else self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words.findall(text.lower())
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case by single characters
        return self.words.findall(text.lower())


def load(path: str) -> Vocabulary:
    if os.path.getsize(path) > LARGEST_VOCABULARY:
        raise ValueError(f"{path}: a vocabulary of at most {LARGEST_VOCABULARY} bytes is broadcast")
    with open(path, encoding="utf-8") as f:
        return Vocabulary(json.load(f))


def _slices(batch: pa.RecordBatch):
    """A batch in parts of at most ``ROWS`` rows and about ``SLICE_BYTES`` of text (a longer text is one of its own)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
    ends = np.cumsum(np.asarray(sizes), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = int(ends[at - 1]) if at else 0
        to = min(at + ROWS, max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))))
        yield batch.slice(at, to - at)
        at = to


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
             with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """One row per input row: the id, the columns in ``keep``, n_tokens, ids_sha256, decoded_sha256, and on request
    ids (array) and decoded (text)."""
    shared = share(docs.sparkSession, load(path))

    def run(batches):
        vocabulary = shared().prepare()
        for batch in (s for b in batches for s in _slices(b)):
            cols = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": [], "decoded": []}
            texts = batch.column(batch.num_columns - 1)
            for found in vocabulary.entries_of([t or "" for t in texts.to_pylist()]):
                ids, decoded = " ".join([x[0] for x in found]), " ".join([x[2] for x in found])
                cols["n_tokens"].append(sum([x[1] for x in found]))
                cols["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                cols["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    cols["ids"].append(np.array(ids.split(), np.int32))
                if with_text:
                    cols["decoded"].append(decoded)
            arrays = [pa.array(cols["n_tokens"], pa.int64()), pa.array(cols["ids_sha256"], pa.string()), pa.array(cols["decoded_sha256"], pa.string())]
            names = ["n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                arrays, names = [*arrays, pa.array(cols["ids"], pa.list_(pa.int32()))], [*names, "ids"]
            if with_text:
                arrays, names = [*arrays, pa.array(cols["decoded"], pa.string())], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *arrays], names=[*batch.schema.names[:-1], *names])

    kept = [id_col, *[k for k in keep if k != id_col]]
    rows = docs.select(*kept, F.col(text_col).alias(free_name(docs.columns)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    schema += ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids + ", decoded string" * with_text
    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the text of their ids (null: empty)."""
    shared = share(rows.sparkSession, load(path))

    @F.pandas_udf("string")
    def text_of(ids):
        vocabulary = shared().prepare()
        return ids.map(lambda x: "" if x is None else vocabulary.decode(x))

    return rows.withColumn("decoded", text_of(ids_col))
