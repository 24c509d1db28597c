"""Bronze daily CSV files: path rules, typed scan and export.

A daily file is ``bronze/{system}/{table}/{prefix}_{YYYY_MM_DD}.csv``; it may
be a single file or a folder of part files (as Spark writes it), plain or compressed.

Reading binds columns by their header names, never by position: the header
line of every part file is read (one small read per file, no Spark job), part files are grouped
by header, each group becomes one CSV scan with an all-STRING schema, and the
groups are unioned by name. Part files of zero length are skipped. Declared columns are then cast to their types
(ANSI casts: a bad value fails the job instead of becoming NULL, and so does an amount with more
decimals than money holds), declared columns a file lacks read as NULL, and extra columns are kept as STRING or get inferred types.
"""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions.dates import DateLike, as_date, file_token
from lakeledger.schemas import MONEY, Lake, SourceSpec
from lakeledger.session import shuffles_end
from lakeledger.sources.infer import inferred_types, with_types
from lakeledger.sources.tables import _FS


def daily_path(lake: Lake, spec: SourceSpec, day: DateLike) -> str:
    return f"{lake.bronze_dir(spec)}/{spec.prefix}_{file_token(day)}.csv"


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a daily file: itself, or the part files of a folder; empty ones are left out."""
    fs = _FS(spark, path)
    if not fs.exists(path):
        raise FileNotFoundError(path)
    status = fs.fs.getFileStatus(fs.p(path))
    if not status.isDirectory():
        return [path] if status.getLen() else []
    return [f"{path}/{s.getPath().getName()}" for s in sorted(fs.fs.listStatus(fs.p(path)), key=lambda s: s.getPath().getName())
            if not s.isDirectory() and s.getLen() and not s.getPath().getName().startswith((".", "_"))]


def read_header(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names from the first line of a CSV file; None when it is empty."""
    fs = _FS(spark, path)
    jvm = fs._jvm
    stream = fs.fs.open(fs.p(path))
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs._conf).getCodec(fs.p(path))
    if codec is not None:
        stream = codec.createInputStream(stream)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
    finally:
        stream.close()
    if not line:
        return None
    line = line.lstrip("\ufeff")
    return tuple(next(csv.reader(io.StringIO(line))))


FILE_DAY = "_dia_arquivo"
#: Exported part files: text is the largest part of a lake. The fastest level makes them about a third; the default one takes four
#: times as long for a fifth less.
PART_FILES = {"header": True, "compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
HEADER_READERS = 16


def scan_csv(spark: SparkSession, paths: str | Iterable[str], spec: SourceSpec,
             with_file_day: bool = False, infer: bool = False) -> DataFrame:
    """Typed rows of one or more daily files of ``spec``. With ``infer`` the columns that ``spec`` does not declare get the
    narrowest type that takes all their texts, over all the files (see ``infer``; one aggregate, only if there are any).

    Missing paths are an error, as in a plain ``spark.read.csv``. A file with
    only a header gives no rows but the declared types. ``with_file_day`` adds
    the date in the name of the file each row came from (``_dia_arquivo``).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    groups: dict[tuple[str, ...], list[str]] = {}
    # Small reads, issued from a few threads so a back-fill of many daily
    # files on object storage is not a long serial loop.
    with ThreadPoolExecutor(max_workers=HEADER_READERS) as pool:
        files = [f for part in pool.map(lambda p: part_files(spark, p), paths) for f in part]
        headers = list(pool.map(lambda f: read_header(spark, f), files))
    for f, header in zip(files, headers):
        if header is not None:
            groups.setdefault(header, []).append(f)
    frames = []
    for header, group in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType(), True) for c in header])
        df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
              .csv(group))
        if with_file_day:
            df = df.withColumn(FILE_DAY, file_day(F.col("_metadata.file_path")))
        frames.append(df)
    if frames:
        raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    else:
        raw = spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType())
                                                      for c in spec.column_names]))
    out = typed(raw, spec)
    if infer:
        declared = {c.lower() for c in (*spec.column_names, FILE_DAY)}
        out = with_types(out, inferred_types(out, [c for c in out.columns if c.lower() not in declared]))
    if with_file_day and FILE_DAY not in out.columns:
        out = out.withColumn(FILE_DAY, F.lit(None).cast(T.DateType()))
    return out


def file_day(path):
    """The date in a daily file's path (of the file itself or one of its part files). Every row asks for it, so it is cut out in
    front of the first ``.csv``; a pattern is tried only where no date stands there."""
    cut = F.replace(F.substring(F.substring_index(path, ".csv", 1), -10, 10), F.lit("_"), F.lit("-"))
    token = F.regexp_extract(path, r"_(\d{4})_(\d{2})_(\d{2})\.csv", 0)
    return F.coalesce(cut.try_cast("date"), F.to_date(F.substring(token, 2, 10), "yyyy_MM_dd"))


def typed(raw: DataFrame, spec: SourceSpec) -> DataFrame:
    """Declared columns cast by name (in declared order), extras kept after them."""
    have = {c.lower(): c for c in raw.columns}
    declared = []
    for name, dtype in spec.columns:
        src = have.get(name.lower())
        col = F.col(f"`{src}`") if src else F.lit(None)
        if src and dtype == MONEY:
            declared.append(exact_money(F.trim(col), name).alias(name))
            continue
        declared.append(F.trim(col).cast(dtype).alias(name) if src and not isinstance(
            dtype, T.StringType) else col.cast(dtype).alias(name))
    known = {c.lower() for c in spec.column_names}
    known.add(FILE_DAY.lower())
    extras = [F.col(f"`{c}`") for c in raw.columns if c.lower() not in known]
    tail = [F.col(FILE_DAY)] if FILE_DAY in raw.columns else []
    return raw.select(*declared, *extras, *tail)


def exact_money(text, name: str):
    """Text as money; an amount with more decimals than money holds fails instead of being rounded."""
    lost = F.raise_error(F.concat(F.lit(f"{name}: more than {MONEY.scale} decimals: "), text))
    # Decided on the digits as written: the places behind the point, without zeros at the end, less the exponent.
    places = F.length(F.regexp_extract(text, r"\.(\d*[1-9])0*(?:[eE]|$)", 1))
    exponent = F.coalesce(F.regexp_extract(text, r"[eE]([+-]?\d{1,6})$", 1).try_cast("int"), F.lit(0))
    ends = F.length(F.regexp_extract(text, r"(0*)(?:\.0*)?(?:[eE]|$)", 1))  # zeros before the point make up for a negative exponent
    some = text.rlike(r"^[^eE]*[1-9]")
    over = some & (F.when(places > 0, places).otherwise(-ends) - exponent > MONEY.scale)
    # Nearly every amount is plain: no exponent, and no more characters behind its first point than money has decimals. It cannot
    # be over, and the patterns, most of the time that a file takes to load, are left out for it.
    point = F.instr(text, ".")
    plain = (F.instr(text, "e") == 0) & (F.instr(text, "E") == 0) & ((point == 0) | (F.length(text) - point <= MONEY.scale))
    return F.when(plain, text.cast(MONEY)).otherwise(F.when(over, lost.cast(MONEY)).otherwise(text.cast(MONEY)))


def export_daily(spark: SparkSession, df: DataFrame, lake: Lake, spec: SourceSpec) -> list:
    """Write ``df`` as one daily CSV (a folder of compressed part files) per date.

    One Spark job writes every date under a staging folder of its own; each date's folder
    is then renamed to the daily file name. Rows without a date belong to no daily file: they
    fail the job that writes the staging folder, so no daily file changes. Returns the dates written.
    """
    day = F.col(spec.date_column)
    dated = F.when(day.isNull(), F.raise_error(F.lit(f"{spec.name}: rows without {spec.date_column} belong to no daily file")).cast("date")).otherwise(day)
    fs = _FS(spark, lake.root)
    base = lake.bronze_dir(spec)
    stage = f"{base}/_export-{uuid.uuid4().hex[:12]}"
    try:
        with shuffles_end(spark):
            (df.withColumn("_dia", dated).hint("rebalance", "_dia")
               .write.mode("overwrite").options(**PART_FILES)
               .partitionBy("_dia").csv(stage))
    except PySparkException as e:
        fs.delete(stage)
        if "belong to no daily file" in str(e):
            raise ValueError(f"{spec.name}: rows without {spec.date_column} belong to no daily file") from e
        raise
    days = []
    for name, is_dir in fs.children(stage):
        if is_dir and name.startswith("_dia="):
            raw = name[len("_dia="):]
            day = as_date(raw)
            target = daily_path(lake, spec, day)
            fs.delete(target)
            fs.rename(f"{stage}/{name}", target)
            days.append(day)
    fs.delete(stage)
    return sorted(days)


__all__ = ["FILE_DAY", "daily_path", "export_daily", "part_files", "read_header", "scan_csv", "typed"]
