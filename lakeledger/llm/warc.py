"""WARC archives: written from pages, read back, assembled into captures.

Writing is DataFrame code: every page becomes three records (request, response or revisit,
metadata) whose request and metadata name the response by WARC-Concurrent-To. Spark's text writer
puts the record separator (two line ends) behind each record, and gzips each file. A payload of at least
``SMALLEST_REVISIT`` bytes is stored once, in the response of the largest page id; other pages with
equal payloads are revisits that refer to it.

Reading parses each file by Content-Length, checks payload digests, and assembles transactions:
records meet by the identifier of their response, and one nested row comes out per capture. Files are cut so that one holds
at most ``FILE_BYTES`` of payload, or one page; a reader holds one file, and its records one after the other.

Defined results: null html is empty; a null url is kept as null; control characters in a url are dropped from the
header; a null page id is never the one referred to (such a page revisits the largest id with its payload); rows equal in page id, url and html
are one capture, whose metadata tell how many rows it stands for (``copies``); other columns are dropped; an empty table
gives an empty archive.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.llm.common import filter_by, id_filter, materialise

SMALLEST_REVISIT = 1000
FILE_BYTES = 64 << 20
#: Pages up to this size are written together, longer ones apart, so that a few long ones do not make many small files.
USUAL_BYTES = 1 << 18
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    dashed = F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(EOL)), F.lit(""))


def _record(kind: Column, record_id: Column, url: Column, content_type: str, block: Column, *headers: Column) -> Column:
    return F.concat(F.lit("WARC/1.1" + EOL), _header("WARC-Type", kind), _header("WARC-Record-ID", record_id), _header("WARC-Date", F.lit(DATE)),
                    _header("WARC-Target-URI", url), *headers, _header("Content-Type", F.lit(content_type)),
                    _header("Content-Length", F.octet_length(block)), F.lit(EOL), block)


def with_reference(pages: DataFrame, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """(page_id, url, html, bytes, digest, ref): ref is the (page_id, url) of the response that a revisit refers to."""
    rows = pages.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    shared = materialise(rows.filter(F.col("bytes") >= smallest).groupBy("digest")
                         .agg(F.count("*").alias("n"), F.max(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("ref"))
                         .filter("n > 1 AND ref IS NOT NULL").select("digest", "ref"), "payloads")
    bitmap = materialise(id_filter(shared, "digest"), "payload-bitmap")
    some = filter_by(rows, bitmap, "digest").join(shared, "digest", "left").select(*rows.columns, "ref")
    none = filter_by(rows, bitmap, "digest", how="left_anti").select(*rows.columns, F.lit(None).cast(shared.schema["ref"].dataType).alias("ref"))
    same = F.col("page_id").eqNullSafe(F.col("ref.page_id"))
    return some.unionByName(none).withColumn("ref", F.when(~same & (F.col("bytes") >= smallest), F.col("ref")))


def with_copies(rows: DataFrame) -> DataFrame:
    """``rows`` with rows equal in page id, url and payload as one, and ``copies``: how many they were. Only the
    digests of all rows are shuffled; payloads only of rows that repeat."""
    same = ("page_id", "url", "digest")
    again = materialise(rows.groupBy(*same).agg(F.count("*").alias("copies")).filter("copies > 1"), "repeated-pages")
    bitmap = materialise(id_filter(again, *same), "repeated-bitmap")
    # The digest stands for the payload, so the first of equal rows is like any of them.
    some = (filter_by(rows, bitmap, *same).groupBy(*same).agg(*[F.first(c).alias(c) for c in rows.columns if c not in same], F.count("*").alias("copies"))
            .select(*rows.columns, "copies"))
    return some.unionByName(filter_by(rows, bitmap, *same, how="left_anti").withColumn("copies", F.lit(1).cast("long")))


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  smallest: int = SMALLEST_REVISIT) -> None:
    """Write ``pages`` as gzipped WARC files into the folder ``path`` (new, and shared by the executors)."""
    base = pages.select(F.col(id_col).alias("page_id"), F.regexp_replace(F.col(url_col), r"[\x00-\x20\x7F]", "").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    rows = with_copies(with_reference(base, smallest))
    revisit = F.col("ref").isNotNull()
    own = _urn(F.lit("capture"), F.col("page_id"), F.col("url"), F.col("digest"))
    target = F.when(revisit, _urn(F.lit("capture"), F.col("ref.page_id"), F.col("ref.url"), F.col("digest")))
    together = _header("WARC-Concurrent-To", own)
    page_host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://([^/?#]*)", 1)
    asked = F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{EOL}Host: "), page_host, F.lit(EOL + EOL))
    answer = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}Content-Length: "), F.col("bytes").cast("string"),
                      F.lit(EOL + EOL), F.when(revisit, F.lit("")).otherwise(F.col("html")))
    facts = F.concat(_header("page-id", F.col("page_id")), _header("payload-length", F.col("bytes")), _header("refers-to-page", F.col("ref.page_id")),
                     _header("copies", F.col("copies")))
    records = rows.select("bytes", F.explode(F.array(
        _record(F.lit("request"), _urn(F.lit("request"), own), F.col("url"), "application/http;msgtype=request", asked, together),
        _record(F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")), own, F.col("url"), "application/http;msgtype=response", answer,
                _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))), _header("WARC-Refers-To", target)),
        _record(F.lit("metadata"), _urn(F.lit("metadata"), own), F.col("url"), "application/warc-fields", facts, together),
    )).alias("value"))
    longest = base.agg(F.max(F.octet_length("html"))).first()[0] or 0
    usual = F.col("bytes") <= USUAL_BYTES
    for part, most in ((records.filter(usual), USUAL_BYTES), (records.filter(~usual), longest)):
        if most >= USUAL_BYTES:
            (part.select("value").write.mode("append").option("lineSep", EOL + EOL).option("compression", "gzip")
             .option("maxRecordsPerFile", 3 * max(1, FILE_BYTES // most)).text(path))


_HEADERS = re.compile(rb"([A-Za-z-]+):[ \t]*([^\r\n]*)\r\n")
_FIELDS = [("record_id", pa.string()), ("type", pa.string()), ("uri", pa.string()), ("date", pa.string()), ("concurrent_to", pa.string()), ("refers_to", pa.string()),
           ("digest", pa.string()), ("length", pa.int64()), ("fields", pa.map_(pa.string(), pa.string())), ("block", pa.binary())]
RECORD = ("record_id string, type string, uri string, date string, concurrent_to string, refers_to string, digest string, length long, "
          "fields map<string,string>, block binary")


def _parse(data: bytes):
    """(headers, block) of every record of an archive file."""
    at = 0
    while at < len(data):
        if not data.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at) + 4
        headers = {k.lower().decode(): v.decode("utf-8", "replace") for k, v in _HEADERS.findall(data, at, end)}
        stop = end + int(headers["content-length"])
        yield headers, data[end:stop]
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        at = stop + 4


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the files in ``path``. Payload digests are checked; without
    ``payload`` the blocks of responses are left out after that."""
    def row(h: dict, block: bytes):
        kind, fields, length = h["warc-type"], None, None
        digest = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if kind == "metadata":
            fields = [(k.decode().lower(), v.decode()) for k, v in _HEADERS.findall(block)]
        elif kind == "response":
            body = block[block.index(b"\r\n\r\n") + 4:]
            length = len(body)
            if digest and hashlib.sha1(body).hexdigest() != digest:
                raise ValueError(f"{h['warc-record-id']}: payload digest does not match")
        return (h["warc-record-id"], kind, h.get("warc-target-uri") or None, h.get("warc-date"), h.get("warc-concurrent-to"), h.get("warc-refers-to"),
                digest, length, fields, block if payload else None)

    def as_batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)], names=[n for n, _ in _FIELDS])

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                data = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                rows, held = [], 0
                for headers, block in _parse(data):
                    rows.append(row(headers, block))
                    held += len(block) if payload else 0
                    if len(rows) == 500 or held > FILE_BYTES // 8:
                        yield as_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the identifier of its response or revisit, and request, response and metadata
    as structs (null where missing). Records meet through concurrent-to identifiers."""
    part = {"request": ["request"], "response": ["response", "revisit"], "metadata": ["metadata"]}
    whole = F.struct("record_id", "type", "uri", "date", "refers_to", "digest", "length", "fields", "block")
    capture = F.when(F.col("type").isin("response", "revisit"), F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id"))
    return (records.select(capture.alias("capture"), "type", whole.alias("r")).groupBy("capture")
            .agg(*[F.first(F.when(F.col("type").isin(kinds), F.col("r")), ignorenulls=True).alias(name) for name, kinds in part.items()]))


def captures(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    return assemble(read_records(spark, path, payload))
