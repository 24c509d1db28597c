"""Benchmark decontamination with a distributed positional inverted index.

Native DataFrame code throughout. The steps:

1. The benchmark is cut into windows of ``WINDOW`` consecutive words (an item
   with fewer words is one window).
2. The corpus frequency of every benchmark term is counted (one pass, partial
   counts per task); a window with a term that the corpus lacks cannot occur.
3. Each window keeps its ``RAREST`` rarest terms. Postings (term, document,
   position) are stored for those terms only, over the whole corpus.
4. Posting lists are intersected from the rarest term on, adjusted by the term's
   offset in the window: what is left are candidate starts.
5. Candidates are compared with the document's words in full: exact phrases.
   With ``slop`` > 0 proximity matches are returned beside the phrases: starts from which every term of the
   window stands at most that many words off its place. The chosen terms' lists are intersected with that
   tolerance, and the other terms are checked on the document's words. Starts one behind the other are one match, and
   one that holds the phrase itself is no proximity match.

The benchmark's terms are broadcast only when its text is at most
``BROADCAST_BYTES``; beyond that the same joins shuffle.

Defined results: a null text or one without words has no hits; null or empty
items are ignored, and so are items without an id; documents are told apart by
(id, text), so rows that repeat an id with another text are judged on their own and equal
rows get equal results; other columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.llm.common import filter_by, id_filter, materialise

WINDOW = 10
RAREST = 3
BROADCAST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of digits, a-z and non-ASCII characters."""
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.array_remove(F.split(lowered, _NOT_WORD, -1), ""), F.array().cast("array<string>"))


def windows_of(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(item, phrase, terms): the distinct windows of each item."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).filter("item IS NOT NULL AND size(w) > 0")
    starts = F.expr(f"sequence(0, greatest(size(w) - {width}, 0))")
    return (w.select("item", "w", F.explode(starts).alias("i"))
            .select("item", F.expr(f"slice(w, i + 1, {width})").alias("terms"))
            .withColumn("phrase", F.concat_ws(" ", "terms")).dropDuplicates(["item", "phrase"]))


def _corpus(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))


def _occurrences(corpus: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc, th, pos, term) of the given terms, joined while a document's words
    are dealt out, so that nothing but the hits leaves the scan."""
    return (corpus.select("doc", "th", F.posexplode(words(F.col("text"))).alias("pos", "term"))
            .join(terms, "term"))


def postings(corpus: DataFrame, phrases: DataFrame, rarest: int, small: bool) -> tuple[DataFrame, DataFrame]:
    """(postings, plan): stored postings of the chosen terms, and for every phrase that
    can occur its rarest terms in order: array of (term, offset)."""
    hint = F.broadcast if small else (lambda x: x)
    terms = phrases.select("phrase", F.posexplode("terms").alias("offset", "term"))
    seen = _occurrences(corpus, hint(terms.select("term").distinct())).groupBy("term").agg(F.count("*").alias("cf"))
    seen = materialise(seen, "term-counts")
    plan = (terms.join(seen, "term", "left").groupBy("phrase")
            .agg(F.array_sort(F.collect_list(F.struct("cf", "term", "offset"))).alias("by_cf"),
                 F.count("cf").alias("found"), F.count("*").cast("int").alias("width"))
            .filter("found = width")
            .select("phrase", "width", F.expr(f"transform(slice(by_cf, 1, {rarest}), x -> struct(x.term, x.offset))").alias("keys")))
    plan = materialise(plan, "phrases")
    chosen = plan.select(F.explode("keys.term").alias("term")).distinct()
    return materialise(_occurrences(corpus, hint(chosen)), "postings"), plan


def intersect(index: DataFrame, plan: DataFrame, rarest: int, slop: int = 0) -> DataFrame:
    """(doc, th, start, width, phrase): starts from which the chosen terms of a phrase stand as in the phrase, each at
    most ``slop`` words off its place."""
    off = F.explode(F.array(*[F.lit(d) for d in range(-slop, slop + 1)]))
    first = plan.select("phrase", "width", "keys", F.col("keys")[0]["term"].alias("term"), F.col("keys")[0]["offset"].alias("offset"))
    found = (index.join(first, "term")
             .select("doc", "th", (F.col("pos") - F.col("offset")).alias("start"), "width", "phrase", "keys"))
    if slop:
        found = found.withColumn("d", off).withColumn("start", F.col("start") + F.col("d")).drop("d")
    found = found.filter("start >= 0")
    for k in range(1, rarest):
        more, done = found.filter(f"size(keys) > {k}"), found.filter(f"size(keys) <= {k}")
        more = more.withColumn("term", F.col("keys")[k]["term"]).withColumn("pos", F.col("start") + F.col("keys")[k]["offset"])
        if slop:
            more = more.withColumn("d", off).withColumn("pos", F.col("pos") + F.col("d")).drop("d")
        more = (more.join(index.withColumnRenamed("doc", "_doc").withColumnRenamed("th", "_th")
                          .withColumnRenamed("term", "_term").withColumnRenamed("pos", "_pos"),
                          F.col("doc").eqNullSafe(F.col("_doc")) & F.col("th").eqNullSafe(F.col("_th"))
                          & (F.col("term") == F.col("_term")) & (F.col("pos") == F.col("_pos")), "left_semi")
                .drop("term", "pos"))
        found = more.unionByName(done)
    return found.distinct() if slop else found


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", width: int = WINDOW, rarest: int = RAREST, slop: int = 0):
    """(matches, phrases): matches has (doc, th, hits, n_hit, near): the exact phrase
    hits of a document as an array of (start, width, phrase), the words that they cover,
    and with ``slop`` the proximity matches that are not phrases; phrases has (item, phrase)."""
    small = (items.agg(F.sum(F.octet_length(F.col(item_text_col)))).first()[0] or 0) <= BROADCAST_BYTES
    phrases = materialise(windows_of(items, item_col, item_text_col, width), "windows")
    corpus = _corpus(docs, id_col, text_col)
    index, plan = postings(corpus, phrases.select("phrase", "terms").dropDuplicates(["phrase"]), rarest, small)
    places = materialise(intersect(index, plan, rarest, slop)
                         .groupBy("doc", "th").agg(F.collect_list(F.struct("start", "width", "phrase")).alias("places")), "places")
    maybe = filter_by(corpus, id_filter(places, "doc", "th"), "doc", "th").dropDuplicates(["doc", "th"])
    maybe = maybe.select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), words(F.col("text")).alias("w"))
    beside = f"""forall(transform(split(p.phrase, ' '), (t, k) -> array_contains(
        slice(w, greatest(p.start + k - {slop}, 0) + 1, least({2 * slop + 1}, p.start + k + {slop + 1})), t)), x -> x)""" if slop else "false"
    same = "concat_ws(' ', slice(w, p.start + 1, p.width)) = p.phrase"
    covered = """aggregate(array_sort(transform(hits, h -> struct(h.start AS s, h.start + h.width AS e))),
        struct(0 AS e, 0L AS n), (a, x) -> struct(greatest(a.e, x.e) AS e, a.n + greatest(0, x.e - greatest(a.e, x.s)) AS n), a -> a.n)"""
    matches = (places.join(maybe, F.col("doc").eqNullSafe(F.col("_doc")) & F.col("th").eqNullSafe(F.col("_th")))
               .select("doc", "th", F.expr(f"filter(places, p -> {same})").alias("hits"),
                       F.expr(f"transform(filter(places, p -> {beside}), p -> struct(p.start, p.width, p.phrase, {same} AS exact))").alias("near"))
               .withColumn("n_hit", F.expr(covered)).filter("size(hits) > 0 OR size(near) > 0"))
    matches = materialise(matches, "matches")
    return (_with_near(matches) if slop else matches.withColumn("near", F.expr("transform(near, p -> struct(p.start, p.width, p.phrase))"))), phrases


def _with_near(matches: DataFrame) -> DataFrame:
    """``matches`` with near as one (first start, width, phrase) for each run of starts without an exact one."""
    spots = matches.select("doc", "th", F.explode("near").alias("p")).select("doc", "th", "p.*")
    order = Window.partitionBy("doc", "th", "phrase").orderBy("start")
    runs = (spots.withColumn("run", F.col("start") - F.row_number().over(order)).groupBy("doc", "th", "phrase", "run")
            .agg(F.min("start").alias("start"), F.max("width").alias("width"), F.max("exact").alias("exact")).filter("NOT exact"))
    near = runs.groupBy(F.col("doc").alias("_d"), F.col("th").alias("_t")).agg(F.array_sort(F.collect_list(F.struct("start", "width", "phrase"))).alias("_near"))
    joined = matches.join(near, F.col("doc").eqNullSafe(F.col("_d")) & F.col("th").eqNullSafe(F.col("_t")), "left")
    joined = joined.withColumn("near", F.coalesce("_near", F.array().cast("array<struct<start:int,width:int,phrase:string>>"))).select(*matches.columns)
    return joined.filter("size(hits) > 0 OR size(near) > 0")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", width: int = WINDOW, rarest: int = RAREST, by_text: bool = False,
                  slop: int = 0) -> DataFrame:
    """One row per input row: the id, n_words, n_hit (words inside benchmark windows), n_items (items with
    occurring windows), items (their ids as strings, sorted), contaminated; with ``by_text`` also text_hash (xxhash64 of the text), and with ``slop`` n_near (proximity
    matches of windows that are not phrases)."""
    matches, phrases = find(docs, items, id_col, text_col, item_col, item_text_col, width, rarest, slop)
    hits = matches.select("doc", "th", F.explode(F.array_distinct("hits.phrase")).alias("phrase"))
    named = (hits.join(phrases.select("phrase", "item"), "phrase").groupBy("doc", "th")
             .agg(F.array_sort(F.collect_set("item")).alias("items")))
    found = (matches.select("doc", "th", "n_hit", F.size("near").cast("long").alias("n_near")).join(
        named.select(F.col("doc").alias("_d"), F.col("th").alias("_t"), "items"),
        F.col("doc").eqNullSafe(F.col("_d")) & F.col("th").eqNullSafe(F.col("_t")), "left").drop("_d", "_t"))
    found = materialise(found, "contaminated")
    base = _corpus(docs, id_col, text_col).select("doc", "th", F.size(words(F.col("text"))).cast("long").alias("n_words"))
    bitmap = materialise(id_filter(found, "doc", "th"), "bitmap")
    joined = (filter_by(base, bitmap, "doc", "th").join(
        found.select(F.col("doc").alias("_d"), F.col("th").alias("_t"), "n_hit", "n_near", "items"),
        F.col("doc").eqNullSafe(F.col("_d")) & F.col("th").eqNullSafe(F.col("_t")), "left")
        .select("doc", "th", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    rest = filter_by(base, bitmap, "doc", "th", how="left_anti").select(
        "doc", "th", "n_words", F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_near"), F.array().cast("array<string>").alias("items"))
    return (joined.unionByName(rest)
            .select(F.col("doc").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                    (F.col("n_hit") > 0).alias("contaminated"), *([F.col("th").alias("text_hash")] if by_text else []), *(["n_near"] if slop else [])))
