"""Line-first quality rules, all in DataFrame expressions (no shuffle, one pass).

Each line is judged first: by its punctuation (it must end in a closing mark and not be riddled with symbols), as
navigation (items between separators) and as boilerplate (notices and prompts). Failing lines are
removed; a document that loses more than ``MAX_LOSS`` percent of its characters is rejected. The
base measures (words, symbols, repeated lines and three-word windows) come first.

Words found twice or more are counted per document by sorting hashes of its three-word windows, and only where
some hash repeats.

Defined results: null and empty texts have no words, fail the base rules and are not kept; every row,
repeated or not, gives one row; other columns are dropped unless named in ``keep``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_LOSS = 30
MIN_WORDS = 50
MAX_REPEAT = 50
#: White space between words, symbols, closing marks, separators, notices.
BLANK = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CLOSING = ".!?:;…\"')]»”’。！？"
SEPARATORS = "|>•·"
NOTICES = ("cookie|javascript|all rights reserved|privacy policy|terms of (use|service)|subscribe|sign (in|up)|log ?in"
           "|click here|read more|copyright|©|lorem ipsum")
#: A notice is a short line; longer ones are prose that mentions such a word.
NOTICE_LENGTH = 200


def _text(s: str) -> str:
    """A SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t") + "'"


def _count(of: str, marks: str) -> str:
    return f"(length({of}) - length(translate({of}, {_text(marks)}, '')))"


def line_passes(line: str = "l") -> str:
    """SQL condition on one line that has a word: it stays."""
    words = f"({_count(line, ' ')} + 1)"
    punctuation = f"instr({_text(CLOSING)}, right(rtrim({_text(BLANK)}, {line}), 1)) > 0 AND 10 * {_count(line, SYMBOLS)} < {words}"
    navigation = f"{_count(line, SEPARATORS)} >= 3 AND 5 * {_count(line, SEPARATORS)} >= {words}"
    boilerplate = f"length({line}) <= {NOTICE_LENGTH} AND lower({line}) rlike {_text(NOTICES)}"
    return f"({punctuation}) AND NOT ({navigation}) AND NOT ({boilerplate})"


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), max_loss: int = MAX_LOSS) -> DataFrame:
    """One row per input row: the id, the columns in ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, and cleaned (the lines that stay)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    names = [id_col, *[k for k in keep if k != id_col]]
    held = [F.col(n).alias(f"_k{i}") for i, n in enumerate(names)]
    own = [f"_k{i}" for i in range(len(names))]
    split = docs.select(*held, text.alias("_t")).select(
        *own, F.expr(r"array_remove(split(_t, '[\\x20\\x09-\\x0D]+', -1), '')").alias("w"),
        F.expr(f"length(translate(_t, {_text(BLANK)}, ''))").cast("long").alias("word_chars"),
        F.expr(_count("_t", SYMBOLS)).cast("long").alias("n_symbols"),
        F.expr(r"filter(split(_t, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')").alias("lines"))
    hashed = split.select(
        *own, F.size("w").cast("long").alias("n_words"), "word_chars", "n_symbols", "lines",
        F.expr("CASE WHEN size(w) < 3 THEN array() ELSE transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) END").alias("h"))
    # Sorted (hash, place) pairs, built only for documents in which a hash repeats.
    paired = hashed.withColumn("s", F.expr(
        "CASE WHEN size(array_distinct(h)) < size(h) THEN sort_array(transform(h, (x, i) -> struct(x, i))) END")).drop("h")
    places = paired.withColumn("p", F.expr(
        "sort_array(transform(filter(s, (e, i) -> (i > 0 AND s[greatest(i - 1, 0)].x = e.x) OR (i < size(s) - 1 AND s[least(i + 1, size(s) - 1)].x = e.x)), e -> e.i))")).drop("s")
    measured = places.select(
        *own, "n_words", "word_chars", "n_symbols", "lines",
        F.expr("size(lines) - size(array_distinct(lines))").cast("long").alias("n_dup_lines"),
        F.expr("coalesce(aggregate(p, struct(-3 AS p, 0L AS n), (a, x) -> struct(x AS p, a.n + least(3, x - a.p) AS n), a -> a.n), 0L)").alias("n_repeat_words"),
        F.expr(f"filter(lines, l -> {line_passes()})").alias("good"))
    total = "aggregate({}, 0L, (a, l) -> a + length(l))"
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    fits = F.expr(f"100 * ({total.format('lines')} - {total.format('good')}) <= {max_loss} * {total.format('lines')}")
    return measured.select(
        *[F.col(o).alias(n) for o, n in zip(own, names)], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & fits).alias("kept"), F.array_join("good", "\n").alias("cleaned"))


def oracle_sql(max_loss: int = MAX_LOSS) -> str:
    """DuckDB statement for the measures and verdicts over ``documents``."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"

    def e(s):
        return "'" + s.replace("'", "''") + "'"

    blank = r"[\x20\x09-\x0D]"
    count = lambda of, marks: f"(length({of}) - length(translate({of}, {q(marks)}, '')))"
    words = f"({count('l', ' ')} + 1)"
    last = f"right(regexp_replace(l, {e(blank + '+$')}, ''), 1)"
    good = (f"contains({q(CLOSING)}, {last}) AND 10 * {count('l', SYMBOLS)} < {words} AND NOT ({count('l', SEPARATORS)} >= 3 AND 5 * {count('l', SEPARATORS)} >= {words}) "
            f"AND NOT (length(l) <= {NOTICE_LENGTH} AND regexp_matches(lower(l), {e(NOTICES)}))")
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(regexp_split_to_array(text, '{blank}+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS tri
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w) x),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM g) y WHERE c > 1),
n AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM r) z GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '{blank}', '', 'g'))::BIGINT AS word_chars,
             {count('text', SYMBOLS)}::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(n.n, 0)::BIGINT AS n_repeat_words, coalesce(list_sum(list_transform(lines, lambda l: length(l))), 0) AS size,
             coalesce(list_sum(list_transform(list_filter(lines, lambda l: {good}), lambda l: length(l))), 0) AS good
      FROM w LEFT JOIN n ON w.doc_id = n.doc_id),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * (size - good) <= {max_loss} * size AS kept FROM f"""
