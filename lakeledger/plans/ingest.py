"""Bronze -> silver jobs.

``ingest`` loads one daily file of one source: the first load creates the
table from that file; afterwards an append-only source replaces the file's
date (rows of other dates in the file are appended to their own dates, and
reported), and the returns source is upserted on its key.

``ingest_range`` loads many daily files with the result of loading them one
by one in date order. For an append source that is always one pass: rows of
another date in a file are kept or dropped by a row filter that states what
the day-by-day replaces would leave. For the upsert source it is one job
holding, per key, the row of the latest file, as many times as its first file
holds the key (a later file repeating a known key is an error there as it is day by day).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions.dates import DateLike, as_date, sorted_dates
from lakeledger.operators.maintenance import SPREAD, co_partitioned, with_keys, without_keys
from lakeledger.schemas import SOURCES, Lake, SourceSpec
from lakeledger.session import scratch_dir
from lakeledger.sources import tables
from lakeledger.sources.bronze import FILE_DAY, daily_path, scan_csv


def _spec(source: SourceSpec | str) -> SourceSpec:
    return SOURCES[source] if isinstance(source, str) else source


def ingest(spark: SparkSession, lake: Lake, source: SourceSpec | str, day: DateLike,
           path: str | None = None, batch: tuple[str, int] | None = None, infer: bool = False) -> dict:
    """Load the daily file of ``source`` for ``day`` into its silver table. With ``infer`` undeclared columns get inferred
    types, which may widen those that the table has."""
    spec, day = _spec(source), as_date(day)
    df = scan_csv(spark, path or daily_path(lake, spec, day), spec, infer=infer)
    target = lake.silver(spec)
    if not tables.open_for_write(spark, target):
        buckets = (spec.key_column, spec.buckets) if spec.key_column and spec.buckets else None
        tables.create_table(spark, target, df, spec.date_column, batch=batch, buckets=buckets)
        return {"source": spec.name, "day": day, "mode": "create"}
    if spec.append_only:
        out = tables.write_partitions(spark, target, df, replace=[day], append_others=True,
                                      count_appended=True, batch=batch, widen=infer)
        mode = "replace"
    else:
        out = tables.upsert_table(spark, target, df, spec.key_column, batch=batch)
        mode = "upsert"
    return {"source": spec.name, "day": day, "mode": mode, **_with_strays(out, {day}, spec)}


def _with_strays(out: dict, days: set, spec: SourceSpec) -> dict:
    """``out`` with the dates, and for append sources the rows, that lie outside the loaded days."""
    strays = [d for d in out.get("appended", []) if d not in days] if spec.append_only else []
    return {**out, "stray_dates": strays, "stray_rows": sum(out.get("appended_rows", {}).get(d, 0) for d in strays)}


def ingest_range(spark: SparkSession, lake: Lake, source: SourceSpec | str,
                 days: list[DateLike], batch: tuple[str, int] | None = None) -> dict:
    """Load the daily files of ``days`` in one job, with the result of loading them one by one
    in date order. A first load takes its columns from the first day's file, and the
    other days follow. ``batch`` names the stream batch that asks for it (see ``tables``)."""
    spec = _spec(source)
    days = sorted_dates(days)
    if not days:
        return {"source": spec.name, "days": [], "mode": "none"}
    target = lake.silver(spec)
    exists = tables.open_for_write(spark, target)
    if exists and tables.applied(spark, target, batch):
        return {"source": spec.name, "days": days, "mode": "skipped"}
    days_left = days
    if not spec.append_only:
        begun = (f"{batch[0]}.first", batch[1]) if batch else None
        if not exists:
            ingest(spark, lake, spec, days[0], batch=begun)
        if not exists or tables.applied(spark, target, begun):
            days_left = days[1:]
        if not days_left:
            return {"source": spec.name, "days": days, "mode": "create"}
    df = scan_csv(spark, [daily_path(lake, spec, d) for d in days_left], spec, with_file_day=True)
    if spec.append_only:
        # Loading day by day in date order, a row dated D found in the file of
        # day F survives unless D's own file is in the batch and loads after
        # F (its replace then clears D). That is a row filter, so the whole
        # batch is one pass over the files and one write, strays included.
        c = F.col(spec.date_column)
        rows = df.filter(c.isNull() | ~c.isin(days) | (F.col(FILE_DAY) >= c)).drop(FILE_DAY)
        if not exists:
            tables.create_table(spark, target, rows, spec.date_column, batch=batch)
            return {"source": spec.name, "days": days, "mode": "create"}
        out = tables.write_partitions(spark, target, rows, replace=days, append_others=True,
                                      count_appended=True, batch=batch)
        return {"source": spec.name, "days": days, "mode": "one_job", **_with_strays(out, set(days), spec)}
    work = scratch_dir(spark, f"ingest-{spec.name}")
    try:
        rows = tables.store(df, f"{work}/parsed")  # the batch's CSV is parsed once
        repeated = tables.store(_repeated_keys(rows, spec.key_column), f"{work}/repeated")
        if repeated.isEmpty():
            rows = rows.drop(FILE_DAY)
        else:
            # The upsert reads its source several times, so these rows are made once.
            rows = tables.store(_latest_rows(rows, repeated, spec.key_column), f"{work}/latest")
            tables._FS(spark, work).delete(f"{work}/parsed")
        out = tables.upsert_table(spark, target, rows, spec.key_column, batch=batch, stored=True)
    finally:
        tables._FS(spark, work).delete(work)
    return {"source": spec.name, "days": days, "mode": "one_job" if exists else "create", **out}


def _repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """The keys that several rows of a batch hold."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key)


def _latest_rows(df: DataFrame, repeated: DataFrame, key: str) -> DataFrame:
    """The rows that loading a batch of files one by one would leave, as one source for one upsert.

    A key's first file inserts (or, known to the table, updates) its rows, and each later file updates
    them all: what stays is the row of the latest file, as many times as the first file holds
    the key. A later file that repeats the key is an error, as it is day by day; a key of the table repeated in its first
    file is found by the upsert itself, since the copies repeat it. A row whose key comes once stays as it is; only those of
    ``repeated`` keys are gathered: one aggregate per (key, file) and
    one per key, joined back on one row per key: no window over a hot key. NULL keys never match, so all
    their rows stay.
    """
    several = with_keys(df, repeated, key)
    per_file = several.groupBy(key, FILE_DAY).agg(F.count(F.lit(1)).alias("_c"))
    # Bounded by the files of the batch.
    per_key = per_file.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(FILE_DAY, "_c"))).alias("_f"))
    again = F.exists(F.slice("_f", 2, F.size("_f")), lambda x: x["_c"] > 1)
    per_key = per_key.filter(F.when(again, F.raise_error(F.concat(
        F.lit("upsert: source key matched more than once: "), F.col(key).cast("string")))).isNull())
    last = per_key.select(key, F.element_at("_f", -1)[FILE_DAY].alias(FILE_DAY),
                          F.when(F.size("_f") > 1, F.col("_f")[0]["_c"]).otherwise(1).cast("int").alias("_times"))
    # Both sides are plain shuffles, so a hot key is split (see ``co_partitioned``).
    latest = co_partitioned(several, key).join(co_partitioned(last, key), [key, FILE_DAY, SPREAD]).withColumn("_times", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")
    return latest.select(*df.columns).unionByName(without_keys(df, repeated, key)).drop(FILE_DAY)


def available_days(spark: SparkSession, lake: Lake, source: SourceSpec | str,
                   lo: DateLike | None = None, hi: DateLike | None = None) -> list:
    """Dates that have a daily file in the bronze folder (a folder listing)."""
    spec = _spec(source)
    fs = tables._FS(spark, lake.root)
    prefix, out = f"{spec.prefix}_", []
    for name, _ in fs.children(lake.bronze_dir(spec)):
        if name.startswith(prefix) and name.endswith(".csv"):
            token = name[len(prefix):-len(".csv")]
            try:
                d = as_date(token.replace("_", "-"))
            except ValueError:
                continue
            if (lo is None or d >= as_date(lo)) and (hi is None or d <= as_date(hi)):
                out.append(d)
    return sorted(out)


def ingest_all(spark: SparkSession, lake: Lake, day: DateLike, parallel: bool = True) -> list:
    """All five sources for one date. They are independent, so their jobs are
    submitted from threads and share the cluster."""
    names = list(SOURCES)
    if not parallel:
        return [ingest(spark, lake, n, day) for n in names]
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return list(pool.map(lambda n: ingest(spark, lake, n, day), names))
