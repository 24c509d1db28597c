"""Silver -> gold jobs.

``refresh`` keeps a gold table current for one processing date: when the
table does not exist yet it is built from the whole silver history, otherwise
only that date is recomputed from the date's silver partitions and replaces
the date's gold partition (an empty result clears it).

``backfill`` recomputes a whole date range in one job: the aggregates carry
the date as a group key, so one pass over the range's silver partitions gives
the same rows as one refresh per date.

Gold frames are small per date (at most products x branches, or branches x
categories, rows), so a rebalanced write gives about one file per date, sorted
by key.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from lakeledger.functions.dates import DateLike, as_date
from lakeledger.operators import gold as G
from lakeledger.schemas import GOLDS, SOURCES, GoldSpec, Lake
from lakeledger.sources import tables


def _spec(name: GoldSpec | str) -> GoldSpec:
    return GOLDS[name] if isinstance(name, str) else name


def gold_frame(spark: SparkSession, spec: GoldSpec | str, inputs: dict[str, DataFrame]) -> DataFrame:
    """The gold rows of ``spec`` from its silver input frames."""
    spec = _spec(spec)
    if spec.name == "produtos":
        return G.gold_product(inputs["devolucao"], inputs["estoque"], inputs["vendas"])
    if spec.name == "fretes":
        return G.gold_freight(spark, inputs["frete"])
    return G.gold_taxes(inputs["tributos"])


def silver_inputs(spark: SparkSession, lake: Lake, spec: GoldSpec | str,
                  lo: DateLike | None = None, hi: DateLike | None = None) -> dict[str, DataFrame]:
    """The silver tables a gold table needs, restricted to [lo, hi] by their
    date column (a partition filter: only those folders are listed and read)."""
    return {name: tables.scan_table(spark, lake.silver(SOURCES[name]), lo, hi)
            for name in _spec(spec).inputs}


def _write_layout(spec: GoldSpec) -> dict:
    return {"rebalance": True, "sort_by": [k for k in spec.keys if k != spec.date_column]}


def build(spark: SparkSession, lake: Lake, name: GoldSpec | str, batch: tuple[str, int] | None = None) -> dict:
    """First load: the gold table from the whole silver history."""
    spec = _spec(name)
    df = gold_frame(spark, spec, silver_inputs(spark, lake, spec))
    tables.create_table(spark, lake.gold(spec), df, spec.date_column, batch=batch, **_write_layout(spec))
    return {"gold": spec.name, "mode": "create"}


def missing_inputs(spark: SparkSession, lake: Lake, name: GoldSpec | str, day: DateLike | None = None) -> list[str]:
    """Silver inputs of a gold table that have not arrived: no table yet or, given a day, no rows of that day
    (a listing, no data is read)."""
    out = []
    for source in _spec(name).inputs:
        src, path = SOURCES[source], lake.silver(source)
        if not tables.table_exists(spark, path) or (day is not None and as_date(day) not in tables.list_partitions(spark, path, src.date_column)):
            out.append(source)
    return out


def refresh_dates(spark: SparkSession, lake: Lake, name: GoldSpec | str, dates: list,
                  batch: tuple[str, int] | None = None) -> dict:
    """Bring several dates (NULL may be one) of a gold table up to date in one job; a table that does not exist is built from the
    whole history. The dates end up as the silver tables have them, however often this runs."""
    spec = _spec(name)
    path = lake.gold(spec)
    if not tables.open_for_write(spark, path):
        return build(spark, lake, spec, batch=batch)
    inputs = {n: tables.scan_dates(spark, lake.silver(SOURCES[n]), dates) for n in spec.inputs}
    out = tables.replace_dates(spark, path, gold_frame(spark, spec, inputs), dates, batch=batch, **_write_layout(spec))
    return {"gold": spec.name, "mode": "replace", **out}


def follow(spark: SparkSession, lake: Lake, batch: tuple[str, int]) -> list[dict]:
    """Bring gold up to date with what a stream's batch changed in silver.

    The change set is read from the records of the silver commits: the dates replaced, appended to, and left
    by rows that an upsert moved. So a batch that is run again after a crash, and finds its silver rows loaded, still refreshes
    the dates that they touched; gold dates are replaced, and a gold table that holds the batch skips it. A gold table one of whose inputs has
    no table yet is left for the batch that brings it.
    """
    touched = {n: {d for b in (batch, (f"{batch[0]}.first", batch[1])) for d in tables.changed_dates(spark, lake.silver(s), b)}
               for n, s in SOURCES.items()}

    def one(spec: GoldSpec) -> dict | None:
        dates = sorted(set().union(*(touched[n] for n in spec.inputs)), key=lambda d: (d is None, str(d)))
        if not dates or missing_inputs(spark, lake, spec):
            return None
        return refresh_dates(spark, lake, spec, dates, batch=batch)
    with ThreadPoolExecutor(max_workers=len(GOLDS)) as pool:
        return [r for r in pool.map(one, GOLDS.values()) if r]


def refresh(spark: SparkSession, lake: Lake, name: GoldSpec | str, day: DateLike) -> dict:
    """Bring one processing date of a gold table up to date (S-12)."""
    spec, day = _spec(name), as_date(day)
    path = lake.gold(spec)
    if not tables.open_for_write(spark, path):
        return build(spark, lake, spec)
    df = gold_frame(spark, spec, silver_inputs(spark, lake, spec, day, day))
    out = tables.replace_dates(spark, path, df, [day], **_write_layout(spec))
    return {"gold": spec.name, "mode": "replace", **out}


def backfill(spark: SparkSession, lake: Lake, name: GoldSpec | str,
             lo: DateLike, hi: DateLike) -> dict:
    """Recompute every date in [lo, hi] in one job (K-04). A table that does not exist yet is
    built from the whole silver history, as the first daily refresh would do."""
    spec, lo, hi = _spec(name), as_date(lo), as_date(hi)
    path = lake.gold(spec)
    if not tables.open_for_write(spark, path):
        return build(spark, lake, spec)
    df = gold_frame(spark, spec, silver_inputs(spark, lake, spec, lo, hi))
    existing = [d for d in tables.list_partitions(spark, path, spec.date_column)
                if d is not None and lo <= d <= hi]
    out = tables.write_partitions(spark, path, df, replace=existing, append_others=True,
                                  **_write_layout(spec))
    return {"gold": spec.name, "mode": "backfill", **out}


def refresh_all(spark: SparkSession, lake: Lake, day: DateLike, parallel: bool = True) -> list:
    """Refresh the three gold tables for one date; they are independent."""
    names = list(GOLDS)
    if not parallel:
        return [refresh(spark, lake, n, day) for n in names]
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return list(pool.map(lambda n: refresh(spark, lake, n, day), names))
