"""The stored product summary, kept by differences (``operators.deltas``).

Beside the gold table stands a table of partial sums, partitioned by date like it. A change set touches a few dates: their partial sums
are read, added to and replaced, and the gold rows of those dates are made from them; no silver row is read. Adding twice would
be wrong, so the sums are committed with the change set's batch (stream name, number) and a batch that they hold is not added
again; the gold dates are replaced, which may be repeated. A run that ends between the two commits is finished by the next call with its
batch, which learns the dates from the record of the sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeledger.operators import deltas
from lakeledger.schemas import GOLD_PRODUTOS, Lake
from lakeledger.session import scratch_dir
from lakeledger.sources import tables

DATE = GOLD_PRODUTOS.date_column


def sums_path(lake: Lake) -> str:
    return f"{lake.gold(GOLD_PRODUTOS)}_parciais"


def build(spark: SparkSession, lake: Lake, sources: dict[str, DataFrame]) -> None:
    """Partial sums and summary from all rows (no table stands there yet)."""
    tables.create_table(spark, sums_path(lake), deltas.partial_sums(sources), DATE)
    summary = deltas.product_summary(tables.scan_table(spark, sums_path(lake)))
    tables.create_table(spark, lake.gold(GOLD_PRODUTOS), summary, DATE)


def apply_changes(spark: SparkSession, lake: Lake, changes: dict[str, DataFrame], batch: tuple[str, int]) -> dict:
    """Bring sums and summary up to date with change sets (source name -> signed rows)."""
    path = sums_path(lake)
    tables.recover(spark, path)
    if not tables.applied(spark, path, batch):
        work = scratch_dir(spark, "delta")
        try:
            sums = deltas.partial_sums(changes)
            sums.write.parquet(f"{work}/sums")  # read for its dates and for the merge
            sums = spark.read.schema(sums.schema).parquet(f"{work}/sums")
            # Dates only: partition metadata.
            dates = [r[0] for r in sums.select(DATE).distinct().collect()]
            merged = deltas.merge(tables.scan_dates(spark, path, dates), sums)
            tables.write_partitions(spark, path, merged, replace=dates, batch=batch)
        finally:
            tables._FS(spark, work).delete(work)
    dates = tables.changed_dates(spark, path, batch)
    summary = deltas.product_summary(tables.scan_dates(spark, path, dates))
    return tables.replace_dates(spark, lake.gold(GOLD_PRODUTOS), summary, dates)
