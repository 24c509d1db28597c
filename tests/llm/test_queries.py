"""Registered queries against their SQL, and the pipeline against a plain version of itself."""

import datetime as dt
import hashlib
import re

import duckdb
import pytest
from helpers import prose
from pyspark.sql import functions as F

import corpus_pipeline
from lakeledger.llm import pii, toxicity
from lakeledger.llm.queries import ORACLE, QUERIES, op6_model
from lakeledger.session import scratch_dir

SF = "/root/testdata/sf0.001"


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(v.isoformat() if isinstance(v, dt.date) else v for v in (r[i] for i in order)) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, res.fetchall())


def test_there_is_a_query_for_each_operator():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 14))


def fixture_folder(spark):
    """A small corpus with every case that a stage must catch, as tables in a folder."""
    path = scratch_dir(spark, "test-corpus")
    vile = [(i, " ".join(prose(i, 40)) + " vilezz wretchqq scumjj " + " ".join(prose(i + 500, 40))) for i in range(90)]
    clean = [(1000 + i, " ".join(prose(3000 + i, 90))) for i in range(90)]
    leak = " ".join(prose(9999, 25))
    base = prose(7777, 120)
    near = []
    for i in range(6):
        w = list(base)
        w[20 * i] = f"edit{i}"
        near.append((2000 + i, " ".join(w)))
    other = [(3000, "x " + leak + " y " + " ".join(prose(1, 50))), (3001, "mail a@b.co from 1.2.3.4 " + " ".join(prose(2, 50))), (3002, None), (3003, ""), (3004, clean[0][1])]
    docs = vile + clean + near + other
    spark.createDataFrame([(d, t, "en" if d % 2 else None, None, None if t is None else len(t)) for d, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    labels = [(d, 1, 1) for d, _ in vile] + [(d, 1, 0) for d, _ in clean]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, vile, leak


def plain_pipeline(spark, path, docs, leak):
    """The stages on lists: scores by the stage's own model, the rest by brute force."""
    import public_tokenizers
    from tokenizers import Tokenizer

    frame = spark.read.parquet(f"{path}/documents.parquet")
    score = {r["doc_id"]: r["score"] for r in toxicity.score(frame, op6_model(frame, spark.read.parquet(f"{path}/labels.parquet"))).collect()}
    left = [(d, t) for d, t in docs if score[d] < 0.7]
    shingles = {d: {tuple((t or "").lower().split()[i:i + 5]) for i in range(max(1, len((t or "").split()) - 4))} - {()} for d, t in left}
    parent = {d: d for d, _ in left}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(parent)
    for a in ids:
        for b in ids:
            if a < b and shingles[a] and shingles[b] and 4 * len(shingles[a] & shingles[b]) >= 3 * len(shingles[a] | shingles[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    left = [(d, t) for d, t in left if find(d) == d]
    w = leak.split()
    windows = {tuple(w[i:i + 10]) for i in range(len(w) - 9)}
    left = [(d, t) for d, t in left if not any(tuple((t or "").split()[i:i + 10]) in windows for i in range(len((t or "").split())))]

    def redacted(text):
        spans = sorted((a, b, k) for k, a, b in pii.base_spans(text))
        for a, b, k in reversed(spans):
            text = text[:a] + f"[{pii.KINDS[k].upper()}]" + text[b:]
        return text
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    out = {}
    for d, t in left:
        found = library.encode(redacted(t or ""), add_special_tokens=False).ids
        out[d] = (len(found), hashlib.sha256(" ".join(map(str, found)).encode()).hexdigest())
    return out


def test_pipeline_against_a_plain_version(spark):
    path, docs, vile, leak = fixture_folder(spark)
    got = corpus_pipeline.run(spark, path).collect()
    want = plain_pipeline(spark, path, docs, leak)
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in got} == want
    assert all(len(r["ids"]) == r["n_tokens"] for r in got)
    kept = set(want)
    assert not kept & {d for d, _ in vile} and 2000 in kept and not kept & {2001, 2005, 3000, 3004} and {1000, 3001, 3002, 3003} <= kept


def test_stages_keep_the_columns_and_pass_an_empty_table(spark):
    path, *_ = fixture_folder(spark)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    none = spark.createDataFrame([], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, path)
        assert out.collect() == []
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_removing_stages_go_by_id_and_text(spark):
    """A clean text stays beside a removed one of the same id; copies and passages without an id go."""
    path, _, _, leak = fixture_folder(spark)
    docs = spark.read.parquet(f"{path}/documents.parquet")

    def table(rows):
        return spark.createDataFrame([(d, t, "en", None, None if t is None else len(t)) for d, t in rows], docs.schema)

    def near(seed, i):
        return " ".join(f"edit{i}" if k == 20 * i else w for k, w in enumerate(prose(seed, 120)))
    clean, other = " ".join(prose(41, 60)), " ".join(prose(42, 60))
    rows = [(1, near(51, 0)), (2, near(51, 1)), (2, clean), (None, near(51, 2)), (None, other), (None, near(52, 0)), (None, near(52, 1)),
            (None, near(52, 1)), (3, None), (None, None), (None, "")]
    left = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.one_of_each_group(spark, table(rows), path).collect()), key=repr)
    family = [r for r in left if r[1] in (near(52, 0), near(52, 1))]
    assert len(family) == 1
    assert left == sorted([(1, near(51, 0)), (2, clean), (None, other), (3, None), (None, None), (None, ""), *family], key=repr)
    rows = [(1, clean + " " + leak), (1, clean), (None, other + " " + leak), (None, other), (2, leak), (None, None), (3, "")]
    left = [(r["doc_id"], r["text"]) for r in corpus_pipeline.decontaminated(spark, table(rows), path).collect()]
    assert sorted(left, key=repr) == sorted([(1, clean), (None, other), (None, None), (3, "")], key=repr)


def test_redacted_documents_count_their_characters(spark):
    path, *_ = fixture_folder(spark)
    out = corpus_pipeline.redacted(spark, spark.read.parquet(f"{path}/documents.parquet"), path)
    assert out.filter(F.col("n_chars") != F.length("text")).isEmpty()
    text = out.filter("doc_id = 3001").first()["text"]
    assert text.startswith("mail [EMAIL] from [IP]") and not re.search("[0-9@]", text)


def test_the_rest_of_the_library_does_not_import_this_subpackage():
    import pathlib

    import lakeledger

    root = pathlib.Path(list(lakeledger.__path__)[0])
    for file in root.rglob("*.py"):
        if "llm" not in file.relative_to(root).parts:
            assert "llm" not in file.read_text()
