"""Load daily files as they land, with Structured Streaming.

The source system drops one file per date into its bronze folder. Instead of
an external scheduler polling for the file and re-running missed days, a
file-stream query watches the folder: its checkpoint (in the shared
``spark.checkpoint.dir``) records which files were already loaded, so every
file is loaded exactly once, late files are picked up by the next run, and a
run after an outage catches up on everything that arrived meanwhile.

The stream only lists files (the ``binaryFile`` source with just the path
column selected does not read file contents). What has landed since the last run is one
batch, whatever its size: no cap cuts a day's part files over batches, and no
age limit leaves a late file out. The batch hands its distinct days to the batch
ingest, in date order. The table's commit records the stream and the batch number, and a
batch that the table already holds is skipped, so one that fails after the commit and
is run again does not append its rows twice.
"""

from __future__ import annotations

import hashlib
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeledger.functions.dates import as_date
from lakeledger.plans import gold as gold_jobs
from lakeledger.plans import ingest as ingest_jobs
from lakeledger.schemas import SOURCES, Lake, SourceSpec
from lakeledger.session import checkpoint_root


# The fixed schema of Spark's binaryFile source.
BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


NO_AGE_LIMIT = "36500d"
#: Sources of a large batch loaded side by side: enough to fill the gaps of each other's small steps. All at once would hold the shuffled
#: rows of all on disk. A batch of fewer bytes of files than ``SMALL_BATCH`` is loaded all at once.
LOADS_AT_ONCE = 2
SMALL_BATCH = 256 << 20


def watch_source(spark: SparkSession, lake: Lake, source: SourceSpec | str,
                 checkpoint: str | None = None, available_now: bool = True,
                 interval: str = "1 hour") -> StreamingQuery:
    """Start a query that loads every new daily file of ``source``.

    ``available_now`` processes what has landed and stops (a scheduled batch
    run with exactly-once file tracking); otherwise the query keeps running and
    checks the folder every ``interval``.
    """
    spec = SOURCES[source] if isinstance(source, str) else source
    checkpoint = checkpoint or f"{checkpoint_root(spark)}/lakeledger/streams/{spec.name}"
    name = "stream-" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("pathGlobFilter", "*.csv*")
             .option("maxFileAge", NO_AGE_LIMIT)
             .option("recursiveFileLookup", "true")
             .load(lake.bronze_dir(spec))
             .select("path"))

    token = F.regexp_extract("path", rf"{re.escape(spec.prefix)}_(\d{{4}}_\d{{2}}_\d{{2}})\.csv", 1)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        # Distinct days only: many part files of one day are one row.
        found = batch.select(token.alias("day")).filter("day <> ''").distinct().collect()
        days = [as_date(r.day.replace("_", "-")) for r in found]
        if days:
            ingest_jobs.ingest_range(spark, lake, spec, sorted(days), batch=(name, epoch_id))

    writer = (files.writeStream.foreachBatch(load_batch)
              .option("checkpointLocation", checkpoint)
              .queryName(f"bronze_{spec.name}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=interval)
    return writer.start()


def watch_lake(spark: SparkSession, lake: Lake, checkpoint: str | None = None, available_now: bool = True,
               interval: str = "1 hour") -> StreamingQuery:
    """Bronze to gold as one stream: a batch loads the new daily files of every source into silver, then refreshes the gold dates
    that those loads changed (``plans.gold.follow``).

    Exactly once over all the tables: silver commits carry the batch number and the changed dates, so a batch
    that failed anywhere and is run again skips what silver holds and still refreshes what that touched.
    """
    checkpoint = checkpoint or f"{checkpoint_root(spark)}/lakeledger/streams/_lake"
    name = "lake-" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).option("pathGlobFilter", "*.csv*")
             .option("maxFileAge", NO_AGE_LIMIT).option("recursiveFileLookup", "true").load(f"{lake.root}/bronze").select("path", "length"))
    # bronze/{system}/{table}/{prefix}_{date}.csv, a file or a folder of part files
    sources = {f"{s.system}/{s.table}/{s.prefix}": s for s in SOURCES.values()}
    daily = r"/bronze/([^/]+/[^/]+/[^/]+)_(\d{4}_\d{2}_\d{2})\.csv"

    def run_batch(batch: DataFrame, epoch_id: int) -> None:
        # One row for each source and day, however many part files.
        found = (batch.groupBy(F.regexp_extract("path", daily, 1).alias("source"), F.regexp_extract("path", daily, 2).alias("day"))
                 .agg(F.sum("length").alias("bytes")).filter("day <> ''").collect())
        days: dict = {}
        for r in found:
            if r.source in sources:
                days.setdefault(r.source, []).append(as_date(r.day.replace("_", "-")))

        def load(source: str) -> None:
            ingest_jobs.ingest_range(spark, lake, sources[source], sorted(days[source]), batch=(name, epoch_id))
        if days:
            small = sum(r.bytes for r in found) < SMALL_BATCH
            with ThreadPoolExecutor(max_workers=len(days) if small else LOADS_AT_ONCE) as pool:
                list(pool.map(load, days))
        gold_jobs.follow(spark, lake, (name, epoch_id))

    writer = files.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint).queryName("bronze_to_gold")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def catch_up_lake(spark: SparkSession, lake: Lake, checkpoint: str | None = None) -> None:
    """Load what has landed for any source, refresh the gold dates that it changes, and return."""
    _finish(watch_lake(spark, lake, checkpoint=checkpoint))


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def catch_up(spark: SparkSession, lake: Lake, source: SourceSpec | str,
             checkpoint: str | None = None) -> None:
    """Load every daily file not loaded yet, then return."""
    _finish(watch_source(spark, lake, source, checkpoint=checkpoint, available_now=True))
