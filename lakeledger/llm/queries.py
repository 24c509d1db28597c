"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeledger.llm import bpe as BPE
from lakeledger.llm import chat as CHAT
from lakeledger.llm import decontaminate as D
from lakeledger.llm import jaccard as JAC
from lakeledger.llm import langid as LANG
from lakeledger.llm import negatives as NEG
from lakeledger.llm import periodic as PERIODIC
from lakeledger.llm import pii as PII
from lakeledger.llm import quality as QUALITY
from lakeledger.llm import substring as SUB
from lakeledger.llm import suffix as SUF
from lakeledger.llm import toxicity as TOX
from lakeledger.llm import warc as WARC
from lakeledger.llm.common import documents
from lakeledger.session import scratch_dir

QUERIES = {}
ORACLE = {}


def _register(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def op9_frame(docs, items):
    out = D.decontaminate(docs, items)
    return out.select("doc_id", "n_words", "n_hit", "n_items",
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@_register("op9_decontaminate")
def op9(spark, sf):
    return op9_frame(documents(spark, sf), documents(spark, sf, "benchmark"))


@_register("op9_proximity")
def op9_proximity(spark, sf):
    """The proximity half of operator 9: documents with benchmark windows whose words stand one place off at most."""
    out = D.decontaminate(documents(spark, sf), documents(spark, sf, "benchmark"), slop=1)
    return out.select("doc_id", "n_words", "n_hit", "n_near", "contaminated")


@_register("op10_substring_dedup")
def op10(spark, sf):
    return SUB.dedup_substrings(documents(spark, sf)).drop("kept")


@_register("op1_suffix_dedup")
def op1(spark, sf):
    return SUF.dedup_bytes(documents(spark, sf)).drop("kept")


#: Vocabulary of op7 (tokenizers file); a parameter of the operator.
def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@_register("op7_bpe")
def op7(spark, sf):
    return BPE.tokenize(documents(spark, sf), tokenizer_path())


@_register("op8_warc", """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to
FROM (SELECT *, strlen(coalesce(html, '')) >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last AS again
      FROM (SELECT page_id, html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages) p) q""")
def op8(spark, sf):
    return op8_frame(documents(spark, sf, "pages"))


def op8_frame(pages):
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    WARC.write_archive(pages, path)
    facts = F.col("metadata.fields")
    return WARC.captures(spark, path, payload=False).select(
        facts["page-id"].cast("long").alias("page_id"), facts["payload-length"].cast("long").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        facts["refers-to-page"].cast("long").alias("refers_to"),
        F.explode(F.array_repeat(F.lit(1), facts["copies"].cast("int"))).alias("_")).drop("_")


@_register("op5_quality", QUALITY.oracle_sql())
def op5(spark, sf):
    return QUALITY.judge(documents(spark, sf)).drop("cleaned")


def crc_of(doc_id, modulus: int):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def op6_model(docs, labels):
    return TOX.train(TOX.training_rows(docs, labels, "doc_id", "text", "toxic", where=lambda i: crc_of(i, 3) != 1))


@_register("op6_toxicity")
def op6(spark, sf):
    docs = documents(spark, sf)
    held_out = F.coalesce(crc_of(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    scored = TOX.score(docs.select("doc_id", held_out, "text"), op6_model(docs, documents(spark, sf, "labels")))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= TOX.THRESHOLD).cast("int").alias("predicted"))


@_register("op2_langid")
def op2(spark, sf):
    docs = documents(spark, sf)
    held_out = F.coalesce(crc_of(F.col("doc_id"), 4) == 2, F.lit(False))
    model = LANG.train(docs, where=~held_out)
    return LANG.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)


@_register("op4_pii")
def op4(spark, sf):
    docs = documents(spark, sf).select("doc_id", "text")
    out = PII.find(docs, PII.train(PII.labelled_words(docs)))
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@_register("op3_jaccard")
def op3(spark, sf):
    return JAC.similar_sets(documents(spark, sf))


def planted_periods(docs):
    """Every tenth document (by h = crc32 of its id) with its words from number a on repeating the p words that stand there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words)
    a = F.pmod(g, n)
    p = 1 + F.floor((n - a) / (3 + g % 8))
    cycle = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    times = F.ceil((n - a) / p).cast("int")
    new = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(F.flatten(F.array_repeat(cycle, times)), F.lit(1), (n - a).cast("int")))
    planted = F.when(n > 0, F.array_join(new, " ")).otherwise(F.col("text"))
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


@_register("op11_periodic_runs")
def op11(spark, sf):
    out = PERIODIC.find_runs(planted_periods(documents(spark, sf)))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                      F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
                      F.sha2("collapsed", 256).alias("collapsed_sha256"))


#: Control strings as a DuckDB pattern; see ``chat.escape``.
_CONTROL_SQL = r"<\\*(?:/?s>|</?SYS>>|\|[a-z_]+\|>)|\[\\*/?INST\]"
SAID = "</s>[INST] ok [/INST]"
#: The layouts that the conversations are stored in before they are formatted.
STORED = ["messages", "from-value", "nested", "prompt", "instruction", "question"]


@_register("op12_chat_format", f"""
WITH rows AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, NULL, 0, 'user', '{SAID}' UNION ALL SELECT -7, NULL, 1, 'assistant', '{SAID}')
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum({len(CHAT.TURN + CHAT.TEXT + CHAT.END)} + length(role) + length(text) + len(regexp_extract_all(role, '{_CONTROL_SQL}'))
           + len(regexp_extract_all(text, '{_CONTROL_SQL}')))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id, alone""")
def op12(spark, sf):
    """The conversations, stored as records of several layouts, formatted and read back."""
    rows = documents(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", SAID), (-7, 1, "assistant", SAID)], "conv_id long, turn long, role string, text string")
    layout = F.get(F.array(*[F.lit(x) for x in STORED]), F.pmod(F.xxhash64("conv_id"), F.lit(len(STORED))).cast("int"))
    records = CHAT.as_records(CHAT.gather(rows.unionByName(extra)), layout)
    out = CHAT.read_back(CHAT.format_records(records, "conv_id"), "conv_id")
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
                      F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


@_register("op13_hard_negatives", f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor({NEG.SCALE} * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= {NEG.POSITIVES}),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS place,
         s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {NEG.LOW} * p.score <= 100 * s.score AND 100 * s.score <= {NEG.HIGH} * p.score)
SELECT anchor_id, positive_id, place::INT AS rank, negative_id, positive_score, negative_score FROM n WHERE place <= {NEG.NEGATIVES}""")
def op13(spark, sf):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = NEG.as_rows(documents(spark, sf, "embeddings"), label=label)
    return NEG.mine(rows, F.col("id") % 100 == 0)
