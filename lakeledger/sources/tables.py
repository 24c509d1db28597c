"""Stored lake tables: Parquet folders partitioned by one DATE column, and for keyed tables by a bucket of the key below it.

Layout of a table at ``path``::

    path/_schema-<n>.json          column names and types; the highest n counts ("table exists" mark)
    path/<col>=<yyyy-mm-dd>/...    one folder per date, plain Spark Parquet files
    path/<col>=<...>/key_bucket=<b>/...   the same of a table created with buckets: hash of the key modulo their number
    path/_staging/<id>/...         a write in progress (ignored by readers)
    path/_trash/<id>/...           replaced partitions, deleted after a commit
    path/_applied/<stream>-<n>     the last batch of a stream that the table holds, and the dates that it changed

Any Parquet reader can read the table (``spark.read.parquet(path)``); folders
starting with ``_`` are skipped by Spark's file listing.

Writes never touch the live folders until the data is complete: Spark writes
the new partitions under ``_staging`` (its own output committer makes that
write safe against lost executors and task retries), a ``_COMMIT.json`` file
records what the write replaces and the schema it brings, and only then are
partition folders swapped by renames. A crash before the commit file leaves the table untouched; a
crash after it is finished by ``recover``, which only writers call: asking whether a table
exists, or reading it, changes nothing. A new schema is a new file; no
file is deleted before its successor is in place, and a first load is staged
like any other write. The protocol needs a file system whose folder renames are
atomic (HDFS, hierarchical object stores); a plain object store, where a rename is many
copies, is not supported. One writer per table is assumed
(as with a daily job); readers may briefly miss a partition during a swap.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.functions.dates import as_date
from lakeledger.operators.maintenance import SIGN, SPREAD, co_partitioned, conform, source_key_counts, update_matched, with_keys, without_keys
from lakeledger.session import scratch_dir, shuffles_end
from lakeledger.sources.infer import widened

SCHEMA_PREFIX = "_schema-"
APPLIED = "_applied"
STAGING = "_staging"
TRASH = "_trash"
COMMIT = "_COMMIT.json"
RETIRED = "_RETIRED"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
BUCKET = "key_bucket"
#: Of stored tables and scratch files, whatever the session's setting.
CODEC = "zstd"
#: A table has at most this many buckets, so the buckets that a load touches are always few enough to broadcast.
MOST_BUCKETS = 4096


class TableNotFound(Exception):
    """Raised by ``scan_table`` when no table exists at the path."""


class TableDamaged(Exception):
    """Date folders stand at the path, but neither a schema nor a commit that would bring one."""


# --------------------------------------------------------------------------
# File system helpers (Hadoop FileSystem, so HDFS, S3A, ABFS and local paths
# all behave the same way).
# --------------------------------------------------------------------------


class _FS:
    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._Path(path).getFileSystem(self._conf)
        self._jvm = jvm

    def p(self, path: str):
        return self._Path(path)

    def exists(self, path: str) -> bool:
        return bool(self.fs.exists(self.p(path)))

    def mkdirs(self, path: str) -> None:
        self.fs.mkdirs(self.p(path))

    def delete(self, path: str) -> None:
        if self.exists(path):
            self.fs.delete(self.p(path), True)

    def rename(self, src: str, dst: str) -> None:
        parent = dst.rsplit("/", 1)[0]
        self.mkdirs(parent)
        if not self.fs.rename(self.p(src), self.p(dst)):
            raise OSError(f"rename failed: {src} -> {dst}")

    def children(self, path: str) -> list[tuple[str, bool]]:
        """(name, is_dir) of the entries of a folder; empty if it does not exist."""
        if not self.exists(path):
            return []
        return [(s.getPath().getName(), bool(s.isDirectory()))
                for s in self.fs.listStatus(self.p(path))]

    def write_text(self, path: str, text: str) -> None:
        """Write a new small file in one step; one that already stands there is kept."""
        if self.exists(path):
            return
        tmp = f"{path}.tmp-{uuid.uuid4().hex[:8]}"
        out = self.fs.create(self.p(tmp), True)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        self.rename(tmp, path)

    def read_text(self, path: str) -> str:
        stream = self.fs.open(self.p(path))
        try:
            reader = self._jvm.java.io.BufferedReader(
                self._jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()


# --------------------------------------------------------------------------
# Partition folder names
# --------------------------------------------------------------------------


def partition_dir(col: str, value: dt.date | None) -> str:
    return f"{col}={NULL_PARTITION if value is None else as_date(value).isoformat()}"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def cell_dir(col: str, date: dt.date | None, bucket: int) -> str:
    return f"{partition_dir(col, date)}/{BUCKET}={bucket}"


def _parse_partition(col: str, name: str) -> tuple[bool, dt.date | None]:
    prefix = f"{col}="
    if not name.startswith(prefix):
        return False, None
    raw = name[len(prefix):]
    if raw == NULL_PARTITION:
        return True, None
    try:
        return True, dt.date.fromisoformat(raw)
    except ValueError:
        return False, None


def list_partitions(spark: SparkSession, path: str, col: str) -> list[dt.date | None]:
    """Dates that have a partition folder (folder listing only, no data read)."""
    out = []
    for name, is_dir in _FS(spark, path).children(path):
        ok, value = _parse_partition(col, name) if is_dir else (False, None)
        if ok:
            out.append(value)
    return out


def folder_marks(spark: SparkSession, path: str) -> str:
    """A mark that changes with every commit to a table without buckets: the names and modification times of its
    date folders (one listing). A commit swaps folders or adds files to them, and either changes a time."""
    fs = _FS(spark, path)
    seen = sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.fs.listStatus(fs.p(path)) if "=" in s.getPath().getName())
    return hashlib.sha256(json.dumps([seen, _schema_versions(fs, path)]).encode()).hexdigest()


def _date_filter(col: str, dates: Iterable[dt.date | None]):
    dates = list(dates)
    real = [as_date(d) for d in dates if d is not None]
    cond = F.col(col).isin(real) if real else F.lit(False)
    if any(d is None for d in dates):
        cond = cond | F.col(col).isNull()
    return cond


# --------------------------------------------------------------------------
# Reading
# --------------------------------------------------------------------------


def _schema_versions(fs: _FS, path: str) -> list[int]:
    names = [n for n, is_dir in fs.children(path) if not is_dir and n.startswith(SCHEMA_PREFIX) and n.endswith(".json")]
    return sorted(int(n[len(SCHEMA_PREFIX):-len(".json")]) for n in names)


def _has_dates(fs: _FS, path: str) -> bool:
    return any(is_dir and "=" in name and not name.startswith(("_", ".")) for name, is_dir in fs.children(path))


def _committed(fs: _FS, path: str) -> bool:
    return any(is_dir and fs.exists(f"{path}/{STAGING}/{stage}/{COMMIT}") for stage, is_dir in fs.children(f"{path}/{STAGING}"))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table was created at ``path``. A pure read: writes in progress are
    left alone. A first load that is not finished does not count; date folders
    without a schema, and without a commit that brings one, are an error."""
    fs = _FS(spark, path)
    if _schema_versions(fs, path):
        return True
    if _has_dates(fs, path) and not _committed(fs, path):
        raise TableDamaged(path)
    return False


def open_for_write(spark: SparkSession, path: str) -> bool:
    """``table_exists`` for the table's writer: interrupted writes are settled first."""
    recover(spark, path)
    return table_exists(spark, path)


def _meta(spark: SparkSession, path: str) -> dict:
    fs = _FS(spark, path)
    versions = _schema_versions(fs, path)
    if not versions:
        raise TableNotFound(path)
    return json.loads(fs.read_text(f"{path}/{SCHEMA_PREFIX}{versions[-1]:08d}.json"))


def read_schema(spark: SparkSession, path: str) -> tuple[T.StructType, str]:
    meta = _meta(spark, path)
    return T.StructType.fromJson(meta["schema"]), meta["partition_column"]


def read_buckets(spark: SparkSession, path: str) -> tuple[str, int] | None:
    """(key column, number of buckets) of a table that has them."""
    buckets = _meta(spark, path).get("buckets")
    return tuple(buckets) if buckets else None


def scan_table(spark: SparkSession, path: str, lo: dt.date | str | None = None,
               hi: dt.date | str | None = None, with_bucket: bool = False) -> DataFrame:
    """A stored table as a DataFrame, columns in table order.

    The schema comes from the table's own schema file, so no Parquet footer is
    read to plan the scan, and partitions written before a column was added
    read that column as NULL. Filters on the date column prune folders.

    With ``lo`` and/or ``hi`` only the dates in [lo, hi] are read, and only
    their folders are handed to Spark: the folder names come from one listing
    of the table root, so a one-day refresh of a table holding years of dates
    lists the files of that day, not of every day. ``with_bucket`` adds the bucket
    of a bucketed table as a column, on which Spark prunes folders too.
    """
    schema, col = read_schema(spark, path)
    shown = [*schema.fieldNames(), BUCKET] if with_bucket else schema.fieldNames()
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())]) if with_bucket else schema).option("basePath", path)
    try:
        if lo is None and hi is None:
            df = reader.parquet(path)
        else:
            lo_d = None if lo is None else as_date(lo)
            hi_d = None if hi is None else as_date(hi)
            dirs = [f"{path}/{partition_dir(col, d)}"
                    for d in sorted(d for d in list_partitions(spark, path, col) if d is not None)
                    if (lo_d is None or d >= lo_d) and (hi_d is None or d <= hi_d)]
            df = reader.parquet(*dirs) if dirs else spark.createDataFrame([], schema)
            c = F.col(col)
            if lo_d is not None:
                df = df.filter(c >= F.lit(lo_d))
            if hi_d is not None:
                df = df.filter(c <= F.lit(hi_d))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise TableNotFound(path) from e
        raise
    return df.select(*shown)


def scan_dates(spark: SparkSession, path: str, dates: Iterable[dt.date | None]) -> DataFrame:
    """The rows of some dates (NULL may be one of them); only their folders are read."""
    _, col = read_schema(spark, path)
    return scan_table(spark, path).filter(_date_filter(col, dates))


def _merged_schema(old: T.StructType | None, df: DataFrame) -> T.StructType:
    if old is None:
        return df.schema
    names = {f.name.lower() for f in old.fields}
    extra = [f for f in df.schema.fields if f.name.lower() not in names]
    return T.StructType(old.fields + extra)


def _widened(stored: T.StructType, df: DataFrame) -> T.StructType:
    new = {f.name.lower(): f.dataType for f in df.schema.fields}
    return T.StructType([T.StructField(f.name, widened(f.dataType, new.get(f.name.lower(), f.dataType), f.name), f.nullable) for f in stored.fields])


def _schema_text(schema: T.StructType, col: str, buckets: tuple[str, int] | None) -> str:
    return json.dumps({"schema": json.loads(schema.json()), "partition_column": col, "buckets": buckets}, indent=1)


def _aligned(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` in the table's column types (new columns keep their own type)."""
    types = {f.name.lower(): f.dataType for f in schema.fields}
    return df.select(*[
        F.col(f.name).cast(types.get(f.name.lower(), f.dataType)).alias(f.name)
        for f in df.schema.fields
    ])


# --------------------------------------------------------------------------
# Writing
# --------------------------------------------------------------------------


def _write_stage(df: DataFrame, stage: str, col: str, buckets: tuple[str, int] | None, rebalance: bool, sort_by: list[str] | None) -> None:
    """Write ``df`` as partition folders under ``stage``.

    ``rebalance`` asks AQE to gather rows by date and then cut the result into
    partitions of the advisory size: a small date lands in one file, while a
    date holding a third of all rows is split over as many tasks as its size
    needs (never one giant task). Rows are sorted by date and keys inside each
    file, so min/max statistics let later scans skip row groups.
    """
    parts = [col]
    if buckets:
        df, parts = df.withColumn(BUCKET, bucket_of(*buckets)), [col, BUCKET]
    if rebalance:
        df = df.hint("rebalance", col)
    if sort_by:
        df = df.sortWithinPartitions(*parts, *sort_by)
    with shuffles_end(df.sparkSession):
        df.write.mode("overwrite").partitionBy(*parts).parquet(stage, compression=CODEC)


def create_table(spark: SparkSession, path: str, df: DataFrame, col: str,
                 rebalance: bool = True, sort_by: list[str] | None = None, batch: tuple[str, int] | None = None,
                 buckets: tuple[str, int] | None = None) -> None:
    """First load: the frame becomes the whole table. A path that already holds a
    table, or date folders of one, is refused. ``buckets`` (key column, number) adds a bucket of the key as
    a second partition level: an upsert then reads and rewrites only the buckets of its keys."""
    fs = _FS(spark, path)
    if buckets and not 1 <= buckets[1] <= MOST_BUCKETS:
        raise ValueError(f"{buckets[1]} buckets: 1 to {MOST_BUCKETS} are possible")
    if open_for_write(spark, path):
        raise FileExistsError(f"a table already stands at {path}")
    stage_id, stage = _stage(path)
    _write_stage(df, stage, col, buckets, rebalance, sort_by)
    staged = _staged(fs, stage, col)
    _commit(fs, path, stage_id, {"column": col, "replace": [], "append": list(staged.values()), "schema": _schema_text(df.schema, col, buckets),
                                 "version": 1, "batch": batch, "dates": _iso(staged)})


def _stage(path: str) -> tuple[str, str]:
    stage_id = uuid.uuid4().hex
    return stage_id, f"{path}/{STAGING}/{stage_id}"


def _staged(fs: _FS, stage: str, col: str) -> dict:
    """Date -> folder name of the partitions in a staging folder."""
    out = {}
    for name, is_dir in fs.children(stage):
        ok, value = _parse_partition(col, name) if is_dir else (False, None)
        if ok:
            out[value] = name
    return out


def _commit(fs: _FS, path: str, stage_id: str, commit: dict) -> None:
    fs.write_text(f"{path}/{STAGING}/{stage_id}/{COMMIT}", json.dumps(commit))
    _finish(fs, path, stage_id)


def applied(spark: SparkSession, path: str, batch: tuple[str, int] | None) -> bool:
    """Whether the table already holds this batch (stream name, number) of a stream."""
    if batch is None:
        return False
    done = [int(n.rsplit("-", 1)[1]) for n, _ in _FS(spark, path).children(f"{path}/{APPLIED}") if n.rsplit("-", 1)[0] == batch[0]]
    return bool(done) and batch[1] <= max(done)


def _iso(dates: Iterable[dt.date | None]) -> list[str | None]:
    return [None if d is None else d.isoformat() for d in sorted(dates, key=_sort_key)]


def changed_dates(spark: SparkSession, path: str, batch: tuple[str, int]) -> list[dt.date | None]:
    """The dates that the last commit of a stream's batch changed: replaced, appended to, or left by rows that moved. They are recorded with
    the commit, so whoever follows the table still learns them after a crash behind it. Empty for a batch that changed nothing
    or is not the stream's last."""
    fs = _FS(spark, path)
    name = f"{path}/{APPLIED}/{batch[0]}-{batch[1]}"
    text = fs.read_text(name) if fs.exists(name) else ""
    return [None if d is None else as_date(d) for d in json.loads(text or "[]")]


def write_partitions(spark: SparkSession, path: str, df: DataFrame,
                     replace: Iterable[dt.date | None] = (), append_others: bool = True,
                     rebalance: bool = True, sort_by: list[str] | None = None,
                     count_appended: bool = False, batch: tuple[str, int] | None = None,
                     cells: Iterable[tuple[dt.date | None, int]] = (), widen: bool = False) -> dict:
    """Write ``df`` into the table in one Spark job.

    Each date in ``replace`` ends up holding exactly the frame's rows of that
    date (none, if the frame has none: the date is cleared). Rows of any other
    date are appended to their partition when ``append_others`` is set and
    rejected otherwise. Returns the dates replaced and the dates appended to;
    with ``count_appended``, also the number of rows appended per date
    (``appended_rows``), counted from the staged files before the commit --
    a second small job, run only when some date was appended to.
    ``batch`` (stream name, number) is recorded with the commit; a batch that the
    table already holds is not applied again. ``cells`` are (date, bucket) pairs of a bucketed
    table that are replaced one by one, as ``replace`` replaces whole dates. New rows are cast to the table's types; with
    ``widen`` a column takes the wider type of the two instead, and an unrelated type is an error (``infer.widened``).
    """
    recover(spark, path)
    if applied(spark, path, batch):
        return {"replaced": [], "appended": [], "skipped": True}
    schema, col = read_schema(spark, path)
    wide = _widened(schema, df) if widen else schema
    df = _aligned(df, wide)
    new_schema = _merged_schema(wide, df)
    replace = {None if d is None else as_date(d) for d in replace}
    if not append_others:
        df = df.filter(_date_filter(col, replace))

    fs = _FS(spark, path)
    buckets = read_buckets(spark, path)
    stage_id, stage = _stage(path)
    _write_stage(df, stage, col, buckets, rebalance, sort_by)
    staged = _staged(fs, stage, col)
    cells = {cell_dir(col, *c): c[0] for c in cells}
    others = {d: name for d, name in staged.items() if d not in replace}
    if buckets:
        # In a bucketed table rows are appended bucket by bucket, beside those that are replaced.
        leaves = {f"{name}/{b}": d for d, name in others.items() for b, is_dir in fs.children(f"{stage}/{name}") if is_dir and b.startswith(f"{BUCKET}=")}
        append = {leaf: d for leaf, d in leaves.items() if leaf not in cells}
    else:
        append = {name: d for d, name in others.items()}
    appended = set(append.values())
    appended_rows = None
    if count_appended:
        appended_rows = {}
        if appended:
            counted = (spark.read.schema(new_schema).option("basePath", stage).parquet(*[f"{stage}/{name}" for name in append])
                       .groupBy(col).count().collect())
            appended_rows = {r[0]: r[1] for r in counted}
    replaced = replace | set(cells.values())
    commit = {
        "column": col,
        "replace": [partition_dir(col, d) for d in replace] + list(cells),
        "append": list(append),
        "batch": batch,
        "dates": _iso(replaced | appended),
    }
    if new_schema != schema:
        commit |= {"schema": _schema_text(new_schema, col, buckets), "version": _schema_versions(fs, path)[-1] + 1}
    _commit(fs, path, stage_id, commit)
    out = {"replaced": sorted(replaced, key=_sort_key), "appended": sorted(appended, key=_sort_key)}
    if appended_rows is not None:
        out["appended_rows"] = appended_rows
    return out


def _sort_key(d):
    return (d is None, d or dt.date.min)


def append_rows(spark: SparkSession, path: str, df: DataFrame, widen: bool = False) -> dict:
    """Append rows to their date partitions (new columns are added)."""
    return write_partitions(spark, path, df, replace=(), append_others=True, widen=widen)


def replace_dates(spark: SparkSession, path: str, df: DataFrame,
                  dates: Iterable[dt.date | None], **layout) -> dict:
    """Replace the listed dates with the frame's rows of those dates only."""
    return write_partitions(spark, path, df, replace=dates, append_others=False, **layout)


def _finish(fs: _FS, path: str, stage_id: str) -> None:
    """Apply a committed staging folder; safe to run again after a crash."""
    stage = f"{path}/{STAGING}/{stage_id}"
    trash = f"{path}/{TRASH}/{stage_id}"
    commit = json.loads(fs.read_text(f"{stage}/{COMMIT}"))

    def retire(name: str) -> None:
        if fs.exists(f"{path}/{name}"):
            fs.rename(f"{path}/{name}", f"{trash}/{name}")

    def install(name: str) -> None:
        if fs.exists(f"{stage}/{name}"):
            fs.rename(f"{stage}/{name}", f"{path}/{name}")

    def moves(name: str) -> list[tuple[str, str]]:
        """What is renamed to append a folder: all of it where the table has none, else file by file."""
        src = f"{stage}/{name}"
        if not fs.exists(f"{path}/{name}"):
            return [(src, f"{path}/{name}")] if fs.exists(src) else []
        names = [n for n, _ in fs.children(src) if not n.startswith((".", "_"))]
        if names and all(n.startswith(f"{BUCKET}=") for n in names):
            return [m for n in names for m in moves(f"{name}/{n}")]
        return [(f"{src}/{n}", f"{path}/{name}/{n}") for n in names]

    # The schema goes in first where the table has one (older rows read a new
    # column as NULL); a first load gets it last, so that a table with a schema is whole.
    def put_schema() -> None:
        if commit.get("schema"):
            fs.write_text(f"{path}/{SCHEMA_PREFIX}{commit['version']:08d}.json", commit["schema"])

    if commit.get("version", 0) > 1:
        put_schema()
    # Renames within a phase are independent; a back-fill over years of dates
    # issues them from a few threads instead of one long serial loop.
    if not fs.exists(f"{stage}/{RETIRED}"):
        # Phase 1: move every replaced partition out of the table.
        _each(retire, commit["replace"])
        fs.write_text(f"{stage}/{RETIRED}", "")
    # Phase 2: install the new partitions and move appended files in.
    _each(install, commit["replace"])
    _each(lambda m: fs.rename(*m), [m for part in _each(moves, commit["append"]) for m in part])
    for date in {name.split("/")[0] for name in commit["replace"] if "/" in name}:
        if not fs.children(f"{path}/{date}"):  # all its buckets are empty now
            fs.delete(f"{path}/{date}")
    put_schema()
    if commit.get("batch"):
        stream, number = commit["batch"]
        old = [n for n, _ in fs.children(f"{path}/{APPLIED}") if n.rsplit("-", 1)[0] == stream]
        fs.write_text(f"{path}/{APPLIED}/{stream}-{number}", json.dumps(commit.get("dates", [])))
        for name in old:
            if int(name.rsplit("-", 1)[1]) < number:
                fs.delete(f"{path}/{APPLIED}/{name}")
    fs.delete(stage)
    fs.delete(trash)


RENAME_THREADS = 16


def _each(fn, names: list) -> list:
    if len(names) <= 1:
        return [fn(n) for n in names]
    with ThreadPoolExecutor(max_workers=min(RENAME_THREADS, len(names))) as pool:
        return list(pool.map(fn, names))


def recover(spark: SparkSession, path: str) -> None:
    """Finish committed writes and drop abandoned ones."""
    fs = _FS(spark, path)
    for stage_id, is_dir in fs.children(f"{path}/{STAGING}"):
        if not is_dir:
            continue
        if fs.exists(f"{path}/{STAGING}/{stage_id}/{COMMIT}"):
            _finish(fs, path, stage_id)
        else:
            fs.delete(f"{path}/{STAGING}/{stage_id}")
    for stage_id, _ in fs.children(f"{path}/{TRASH}"):
        fs.delete(f"{path}/{TRASH}/{stage_id}")


def store(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as Parquet to a scratch folder, and read from there."""
    with shuffles_end(df.sparkSession):
        df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def touched_keys(spark: SparkSession, path: str, source: DataFrame, key: str) -> DataFrame:
    """(key, date[, bucket]) of every stored row. Of a bucketed table only the buckets of the source's keys
    are read: their numbers, at most as many as the table has, prune the table's folders when the query runs."""
    _, col = read_schema(spark, path)
    buckets = read_buckets(spark, path)
    if not buckets or buckets[0] != key:
        return scan_table(spark, path).select(key, col).filter(F.col(key).isNotNull())
    # A comparison on the small side is what makes the planner prune dynamically; it holds for every bucket.
    mine = source.filter(F.col(key).isNotNull()).select(bucket_of(*buckets).alias(BUCKET)).distinct().filter(F.col(BUCKET) >= 0)
    return (scan_table(spark, path, with_bucket=True).select(key, col, BUCKET).join(F.broadcast(mine), BUCKET, "left_semi")
            .filter(F.col(key).isNotNull()).select(key, col, BUCKET))


def upsert_table(spark: SparkSession, path: str, source: DataFrame, key: str,
                 batch: tuple[str, int] | None = None, stored: bool = False, changes: str | None = None) -> dict:
    """Update every column of target rows whose key is in ``source``, insert
    the other source rows; only dates that hold a matched row are rewritten, of a bucketed table only their buckets with one.

    Pass 1 reads just (key, date) of the table, in the source's buckets (``touched_keys``), and joins it with the source's
    per-key counts: that yields the matched keys and their places, and fails the
    job if a matched key occurs twice in the source. Pass 2 rewrites those places
    (only their folders are read): each matched row takes the source values. Source rows without
    a match are appended to their dates, as are rows whose date changed to one
    that is not rewritten. Extra source columns are dropped (no schema
    evolution on upsert), as in a MERGE.

    Both passes read the source, so it is first written once as Parquet under the
    shared checkpoint folder (one parse of the day's CSV, lineage cut there) and deleted when
    the upsert is done; ``stored`` says that the caller has done that.

    ``changes`` names a folder for the rows that the upsert takes out (column ``_sinal`` -1) and brings in (+1), written before the commit.
    """
    recover(spark, path)
    if applied(spark, path, batch):
        return {"replaced": [], "appended": [], "skipped": True}
    target = scan_table(spark, path)
    schema, col = read_schema(spark, path)
    buckets = read_buckets(spark, path)
    place = [col, BUCKET] if buckets and buckets[0] == key else [col]
    conformed = conform(source, target)
    work = scratch_dir(spark, "upsert")
    try:
        if not stored:
            conformed = store(conformed, f"{work}/source")
        hits = co_partitioned(touched_keys(spark, path, conformed, key), key).join(
            co_partitioned(source_key_counts(conformed, key), key), [key, SPREAD], "inner")
        # The check names a column of each side, so the optimizer cannot evaluate
        # it below the join, i.e. on source keys that match nothing.
        hits = hits.filter(F.when(F.col("_n") > 1, F.raise_error(F.concat(
            F.lit("upsert: source key matched more than once: "), F.col(key).cast("string"),
            F.lit(" (target date "), F.coalesce(F.col(col).cast("string"), F.lit("NULL")), F.lit(")")))).isNull())
        matched = hits.select(key, *place).distinct()
        matched = store(matched, f"{work}/matched")
        # Bounded by the number of folders: partition metadata, not data.
        places = [tuple(r) for r in matched.select(*place).distinct().collect()]
        dirs = [f"{path}/{cell_dir(col, *p) if len(p) > 1 else partition_dir(col, *p)}" for p in places]
        old = (spark.read.schema(schema).option("basePath", path).parquet(*dirs).select(*schema.fieldNames())
               if dirs else spark.createDataFrame([], schema))
        keys = matched.select(key).distinct()
        new = without_keys(conformed, keys, key)
        # Only source rows with a match update anything: the others are not sorted and gathered by key.
        update = with_keys(conformed, keys, key)
        if changes:
            gone = with_keys(old, keys, key)
            come = update_matched(gone, update, key).unionByName(new)
            with shuffles_end(spark):
                gone.withColumn(SIGN, F.lit(-1)).unionByName(come.withColumn(SIGN, F.lit(1))).write.mode("overwrite").parquet(changes)
        rows = update_matched(old, update, key).unionByName(new)
        if len(place) > 1:
            return write_partitions(spark, path, rows, cells=places, batch=batch)
        return write_partitions(spark, path, rows, replace=[p[0] for p in places], append_others=True, batch=batch)
    finally:
        _FS(spark, work).delete(work)
