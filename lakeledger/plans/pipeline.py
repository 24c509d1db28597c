"""End-to-end runs: one day, or a back-fill of many days.

The order is the dependency order of the layers: every source of a date is
loaded into silver before the gold tables of that date are refreshed.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from lakeledger.functions.dates import DateLike, as_date
from lakeledger.plans import gold as gold_jobs
from lakeledger.plans import ingest as ingest_jobs
from lakeledger.schemas import GOLDS, SOURCES, Lake


def run_day(spark: SparkSession, lake: Lake, day: DateLike, parallel: bool = True) -> dict:
    """Bronze -> silver -> gold for one processing date (K-03)."""
    day = as_date(day)
    silver = ingest_jobs.ingest_all(spark, lake, day, parallel=parallel)
    gold = gold_jobs.refresh_all(spark, lake, day, parallel=parallel)
    return {"day": day, "silver": silver, "gold": gold}


def backfill(spark: SparkSession, lake: Lake, lo: DateLike, hi: DateLike,
             parallel: bool = True) -> dict:
    """Every daily file in [lo, hi] into silver, then every gold date in
    [lo, hi] recomputed -- one job per source and per gold table, not one per
    day (K-04). Sources are independent, and so are gold tables: each group's
    jobs are submitted together and share the cluster."""
    lo, hi = as_date(lo), as_date(hi)

    def load(name: str) -> dict:
        days = ingest_jobs.available_days(spark, lake, name, lo, hi)
        return ingest_jobs.ingest_range(spark, lake, name, days)

    def rebuild(name: str) -> dict:
        return gold_jobs.backfill(spark, lake, name, lo, hi)

    silver = dict(zip(SOURCES, _each(load, list(SOURCES), parallel)))
    gold = dict(zip(GOLDS, _each(rebuild, list(GOLDS), parallel)))
    return {"from": lo, "to": hi, "silver": silver, "gold": gold}


def _each(fn, names: list[str], parallel: bool) -> list:
    if not parallel:
        return [fn(n) for n in names]
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return list(pool.map(fn, names))
