"""Byte-pair encoding, WARC archives and quality rules."""

import gzip
import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import duckdb
import pytest
from helpers import empty, frame, odd_rows, prose, with_extras
from tokenizers import Tokenizer

from lakeledger.llm.queries import ORACLE, op8_frame
from lakeledger.llm import bpe, quality, warc
from lakeledger.session import scratch_dir

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH).prepare()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


TEXTS = ["", " ", "Hello's WORLD 'start don't  l'll 123", "ΣΑΣ ς İI ẞ", "a\x1cb\x85c\xa0d　e", "<|endoftext|>x <|startoftext|>", "<|endoftext", "é é ﬁ",
         "日本語テキスト", "\U0001f600\U0001f601!!", "a" * 3000, "ab" * 1500 + "!", "'" * 40, "x" * 101 + " " + "y" * 99, "\x00\x01", "½²③ ٣"]


def test_encoding_and_decoding_as_the_library(vocabulary, library):
    rng = random.Random(3)
    made = ["".join(rng.choice("abcdeihtn's1 .é<|") for _ in range(rng.randint(1, 200))) for _ in range(400)]
    for text in TEXTS + made + [" ".join(prose(1, 500))]:
        ids = library.encode(text, add_special_tokens=False).ids
        got = [int(i) for e in vocabulary.entries(text) for i in e[0].split()]
        assert got == ids, text[:80]
        assert vocabulary.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_every_token_of_the_automaton_encodes_as_itself(vocabulary):
    """And pairs are compatible exactly when plain merging leaves them."""
    rank = {pair: k for k, pair in enumerate(vocabulary.merges)}

    def merged(symbols):
        symbols = list(symbols)
        while True:
            best = min(((rank.get(p, 1 << 30), i) for i, p in enumerate(zip(symbols, symbols[1:]))), default=(1 << 30, 0))
            if best[0] == 1 << 30:
                return symbols
            symbols[best[1]:best[1] + 2] = ["".join(symbols[best[1]:best[1] + 2])]
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("etaoinshrdl") for _ in range(rng.randint(1, 14)))
        plain = merged([*word[:-1], word[-1] + "</w>"])
        assert [vocabulary.vocab[t] for t in plain] == vocabulary.encode_word(word)


def test_tokenize_frame_and_round_trip(spark, library):
    rows = odd_rows("Some TEXT <|endoftext|> here") + list(enumerate(TEXTS, 1000))
    got = bpe.tokenize(with_extras(frame(spark, rows)), PATH, keep=("key",), with_ids=True, with_text=True)
    back = bpe.decode(got.withColumnRenamed("decoded", "first"), PATH)
    out = back.collect()
    assert len(out) == len(rows) and all(r["first"] == r["decoded"] for r in out)
    want = Counter()
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out) == want
    assert bpe.tokenize(empty(spark), PATH).collect() == []


def odd_words(rng, n):
    """Words as the pattern matches them: parts of the vocabulary's kind of letters, runs, marks, other scripts, long ones."""
    parts = ["the", "tion", "ing", "an", "er", "re", "on", "a", "b", "ab", "aa", "é", "ñ", "σ", "日", "本", "x", "q", "zz"]
    made = {"".join(rng.choice(parts) for _ in range(rng.randint(1, 9))) for _ in range(n)}
    return sorted(made | {"!" * k for k in range(1, 70)} | {"a" * k for k in range(1, 70)} | {"'s", "7", "½", "x" * 500, "語" * 40, "\x00"})


def test_words_side_by_side_are_encoded_as_alone_and_as_by_the_library(library):
    vocabulary = bpe.load(PATH).prepare()
    words = odd_words(random.Random(7), 3000)
    tokens, count = vocabulary._encode_together(words)
    ends = count.cumsum().tolist()
    for w, n, end in zip(words, count.tolist(), ends):
        assert tokens[end - n:end].tolist() == vocabulary._encode_alone(w), w
        assert [vocabulary.ids[t] for t in tokens[end - n:end]] == library.encode(w, add_special_tokens=False).ids, w


def test_new_words_of_a_slice_are_encoded_in_one_go(library, monkeypatch):
    """One pass for all new short words of a slice, none for words that are known; long words go alone and are not held."""
    vocabulary = bpe.load(PATH).prepare()
    calls, alone = [], []
    together, one = vocabulary._encode_together, vocabulary._encode_alone
    monkeypatch.setattr(vocabulary, "_encode_together", lambda words: calls.append(len(words)) or together(words))
    monkeypatch.setattr(vocabulary, "_encode_alone", lambda word: alone.append(word) or one(word))
    words = odd_words(random.Random(11), 2000)
    texts = [" ".join(words[k::20]) + " <|endoftext|>" * (k % 3) for k in range(20)] * 2
    for _ in range(2):
        for text, found in zip(texts, vocabulary.entries_of(texts), strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert " ".join(x[0] for x in found) == " ".join(map(str, want))
            assert sum(x[1] for x in found) == len(want)
            assert " ".join(x[2] for x in found) == library.decode(want, skip_special_tokens=False)
    assert len(calls) == 1 and calls[0] > 1500
    assert all(len(w.encode()) > bpe.LONG_WORD for w in alone)
    assert max(len(w) for w in vocabulary.known if isinstance(w, str)) <= bpe.LONGEST_HELD


def test_small_tables_of_words_and_pairs_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_TABLE", 50)
    monkeypatch.setattr(bpe, "PAIR_TABLE", 8)
    vocabulary = bpe.load(PATH).prepare()
    words = odd_words(random.Random(13), 600)
    for k in range(0, len(words), 30):
        texts = [" ".join(words[k:k + 30]), "the end <|endoftext|>", ""]
        for text, found in zip(texts, vocabulary.entries_of(texts), strict=True):
            assert [int(i) for x in found for i in x[0].split()] == library.encode(text, add_special_tokens=False).ids
        assert len(vocabulary.known) <= 50 + 40


def test_words_of_ascii_texts_are_those_of_the_full_pattern(vocabulary):
    rng = random.Random(17)
    assert vocabulary.ascii_words is not vocabulary.words
    texts = [chr(a) + chr(b) for a in range(128) for b in range(128)]
    texts += ["".join(rng.choice("'strevmld 0a\x1c\x0b\t|_") for _ in range(40)) for _ in range(2000)]
    for t in texts:
        assert vocabulary.ascii_words.findall(t.lower()) == vocabulary.words.findall(t.lower()), repr(t)


def test_slices_hold_rows_and_text_within_bounds(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "ROWS", 4)
    monkeypatch.setattr(bpe, "SLICE_BYTES", 100)
    texts = [None, "", "x" * 60, "é" * 30, "y" * 500, "z" * 99, "a", "b", "c", "d", "e", None]
    whole = pa.RecordBatch.from_arrays([pa.array(range(len(texts) + 2)), pa.array(["u", "v", *texts])], names=["doc_id", "text"])
    got = [s.column(1).to_pylist() for s in bpe._slices(whole.slice(2))]
    assert [t for s in got for t in s] == texts
    assert all(len(s) <= 4 and (len(s) == 1 or sum(len((t or "").encode()) for t in s) <= 100) for s in got)


def test_a_vocabulary_beyond_the_bound_is_refused(monkeypatch):
    monkeypatch.setattr(bpe, "LARGEST_VOCABULARY", 10)
    with pytest.raises(ValueError):
        bpe.load(PATH)


# --- WARC --------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"


def page_rows():
    big = "<html>" + "é" * 600 + "</html>\r\n\r\nWARC/1.1\r\n"
    return [(1, "http://a.example/x", big), (2, "http://b.example/", big), (3, "http://c.example/", "small"), (4, "http://d.example/", "small"),
            (5, None, None), (6, "http://e.example/\r\nEvil: 1", ""), (None, "http://f.example/", big), (7, "http://g.example/", big), (8, "u", big + "x")]


def test_archive_round_trip(spark):
    path = scratch_dir(spark, "test-warc")
    warc.write_archive(with_extras(frame(spark, page_rows(), PAGES)).repartition(2), path)
    got = warc.captures(spark, path).collect()
    by_id = {r["metadata"]["fields"].get("page-id"): r for r in got}
    assert len(got) == len(page_rows())
    kinds = {k: (r["response"]["type"], r["metadata"]["fields"].get("refers-to-page")) for k, r in by_id.items()}
    assert kinds == {"1": ("revisit", "7"), "2": ("revisit", "7"), "7": ("response", None), None: ("revisit", "7"), "8": ("response", None),
                     **{str(k): ("response", None) for k in (3, 4, 5, 6)}}
    for page, url, html in page_rows():
        r = by_id[None if page is None else str(page)]
        body = (html or "").encode()
        assert r["response"]["digest"] == hashlib.sha1(body).hexdigest()
        assert int(r["metadata"]["fields"]["payload-length"]) == len(body)
        assert r["request"]["block"].startswith(b"GET ")
        stored = r["response"]["block"].split(b"\r\n\r\n", 1)[1]
        assert stored == (body if r["response"]["type"] == "response" else b"")
        if page == 6:
            assert r["response"]["uri"] == "http://e.example/Evil:1"
    own = by_id["7"]["response"]["record_id"]
    assert by_id["1"]["response"]["refers_to"] == own and by_id["1"]["capture"] == by_id["1"]["response"]["record_id"]


def test_archive_files_are_gzip_and_rows_that_repeat_are_one_capture(spark):
    path = scratch_dir(spark, "test-warc")
    warc.write_archive(frame(spark, [(1, "u", "x" * 2000)] * 3 + [(1, "u", "other")], PAGES), path)
    got = warc.captures(spark, path).collect()
    assert sorted((r["metadata"]["fields"]["page-id"], r["response"]["type"], r["metadata"]["fields"]["copies"]) for r in got) == [("1", "response", "1"), ("1", "response", "3")]
    content = spark.read.format("binaryFile").load(path).select("content").first()[0]
    assert gzip.decompress(content).startswith(b"WARC/1.1\r\n")


def test_query_has_a_row_for_each_row_of_pages(spark):
    rows = page_rows() + [page_rows()[0]] * 2 + [page_rows()[6], (7, "http://g.example/", page_rows()[0][2]), (None, None, None), (None, None, None), (5, None, None), (None, "v", "z" * 1500), (None, "v", "z" * 1500)]
    df = frame(spark, rows, PAGES)
    got = sorted((tuple(r) for r in op8_frame(df).collect()), key=repr)
    con = duckdb.connect()
    con.register("pages", df.toArrow())
    want = sorted(con.execute(ORACLE["op8_warc"]).fetchall(), key=repr)
    assert len(got) == len(rows) and got == want


def test_long_pages_have_files_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 4000)
    monkeypatch.setattr(warc, "USUAL_BYTES", 1000)
    path = scratch_dir(spark, "test-warc")
    rows = [(i, "u", f"{i} " + "x" * (i * 97 % 900)) for i in range(40)] + [(100 + i, "u", f"{i} " + "y" * 1500) for i in range(4)]
    warc.write_archive(frame(spark, rows, PAGES).coalesce(1), path)
    files = [gzip.decompress(r[0]) for r in spark.read.format("binaryFile").load(path).select("content").collect()]
    assert max(f.count(b"WARC-Type: response") for f in files) <= 4 and all(f.count(b"WARC-Type: response") <= 2 for f in files if b"yyy" in f)
    assert {r["metadata"]["fields"]["page-id"] for r in warc.captures(spark, path).collect()} == {str(r[0]) for r in rows}


def test_records_alone_and_damaged_files(spark):
    rec = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:1>\r\nWARC-Payload-Digest: sha1:%s\r\nContent-Length: 20\r\n\r\nHTTP/1.1 200\r\n\r\nbody\r\n\r\n"
    good = rec % hashlib.sha1(b"body").hexdigest().encode()
    (headers, block), = warc._parse(good)
    assert headers["warc-type"] == "response" and block.endswith(b"body")
    with pytest.raises(ValueError):
        list(warc._parse(good[:-2]))
    with pytest.raises(ValueError):
        list(warc._parse(b"junk"))


def test_empty_archive(spark):
    path = scratch_dir(spark, "test-warc")
    warc.write_archive(empty(spark, PAGES), path)
    assert warc.captures(spark, path).collect() == []


# --- quality -----------------------------------------------------------------------


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if tri[w[i], w[i + 1], w[i + 2]] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_measures_against_brute_force(spark):
    rows = odd_rows("Words that end. " * 20) + [(400, "l one.\nl one.\n\n \nl one. "), (401, "a b c a b c d"), (402, "x|y & <z> $ * # %"), (403, " ".join(prose(1, 300, words=6))),
                                                 (404, "a\x0bb\x0cc\rd\x1ee\x85f g")]
    got = quality.judge(with_extras(frame(spark, rows)), keep=("key",)).collect()
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r["doc_id"], *[r[c] for c in cols]) for r in got) == Counter((d, *measures(t)) for d, t in rows)
    assert quality.judge(empty(spark)).collect() == []


def test_lines_and_verdicts(spark):
    good = "\n".join(" ".join(prose(i, 20)) + "." for i in range(5))
    menu = "Home | News | Sport | Contact | Help."
    rows = [(1, good), (2, good + "\n" + menu + "\nWe use cookies."), (3, (menu + "\n") * 30 + good), (4, good.replace(".", "")), (5, "\n".join("w###  x*** $$$ y%%% &&& z." for _ in range(20)) + good)]
    got = {r["doc_id"]: r for r in quality.judge(frame(spark, rows)).collect()}
    assert got[1]["kept"] and got[1]["cleaned"] == good
    assert got[2]["kept"] and got[2]["cleaned"] == good
    assert not any(got[k]["kept"] for k in (3, 4, 5))
