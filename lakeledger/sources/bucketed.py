"""Silver copies bucketed and sorted on the product summary's keys.

The three aggregates of the summary group by date, product and branch, and its joins use the same keys. A copy of each
source that Spark has written in buckets of those keys (``bucketBy``, one file for each bucket, sorted) comes out of the
scan partitioned and sorted as the aggregates and joins need it, so the whole summary runs without an exchange. That pays where the
summary is recomputed from the same silver rows again and again; a copy is written once, with one shuffle.

The buckets are those of Spark's own data source tables: the copies are external tables of the session's catalog (data under ``folder``).
All copies must have the same number of buckets; choose it so that a bucket's rows fit a task.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lakeledger.operators.deltas import MEASURES
from lakeledger.operators.gold import PRODUCT_KEYS, agg_returns, agg_sales, agg_stock
from lakeledger.schemas import SOURCES

BUCKETS = 16


def bucket_keys(source: str) -> list[str]:
    return [MEASURES[source][0], "produto_id", "filial_id"]


def table_name(folder: str, source: str) -> str:
    return f"{source}_{re.sub('[^0-9a-z]', '_', folder.lower())[-40:]}"


def write_bucketed(spark: SparkSession, folder: str, source: str, rows: DataFrame, buckets: int = BUCKETS) -> None:
    """Write the rows of a source as its bucketed copy (a former one is replaced)."""
    keys = bucket_keys(source)
    declared = rows.select(*SOURCES[source].column_names)
    (declared.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", f"{folder}/{source}")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table_name(folder, source)))


def product_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The product summary from the bucketed copies. Merge joins are asked for: on this layout they need neither a shuffle
    nor a broadcast."""
    returns, stock, sales = (spark.table(table_name(folder, s)) for s in ("devolucao", "estoque", "vendas"))
    both = agg_returns(returns).hint("merge").join(agg_stock(stock), PRODUCT_KEYS)
    return both.hint("merge").join(agg_sales(sales), PRODUCT_KEYS)


def drop_bucketed(spark: SparkSession, folder: str) -> None:
    """Take the copies out of the catalog (their files stay)."""
    for source in MEASURES:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(folder, source)}")
