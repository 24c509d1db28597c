"""Report questions asked of the lake: choose a table, load its stored gold rows, filter, sum."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions.dates import DateLike
from lakeledger.operators.reports import REPORTS, distinct_values, report_series
from lakeledger.schemas import GOLDS, Lake
from lakeledger.sources import tables


def _spec(choice: str, product: int | str | None):
    spec = REPORTS[choice]
    if product is not None and not spec.has_product:
        raise ValueError(f"report {choice} has no product")
    return spec


def answer_report(spark: SparkSession, lake: Lake, choice: str, branches: Iterable[str],
                  date_from: DateLike | None = None, date_to: DateLike | None = None,
                  product: int | str | None = None) -> DataFrame:
    """The series of report ``choice`` from its stored gold table. The date range picks the
    partition folders that are read; the other filters reach the Parquet scan."""
    spec = _spec(choice, product)
    gold = tables.scan_table(spark, lake.gold(spec.gold), date_from, date_to)
    return report_series(gold, spec, branches=branches, date_from=date_from, date_to=date_to, product=product)


class ReportSession:
    """Answers many questions from gold tables held in the executors' memory (and disk; a lost block is read again).

    A table is held for one version of it (``tables.folder_marks``, one listing). Every question compares the mark with the
    stored table's, and after a load has committed, the next question drops what is held and reads the new version. No clock
    is involved: an answer is never older than the table at the time of the question. The mark is part of the held
    frame, as Spark would else take a later scan of the same folder for the held one.
    """

    def __init__(self, spark: SparkSession, lake: Lake):
        self.spark, self.lake = spark, lake
        self.held: dict[str, tuple[str, DataFrame]] = {}

    def table(self, gold: str) -> DataFrame:
        path = self.lake.gold(gold)
        version = tables.folder_marks(self.spark, path)
        if gold not in self.held or self.held[gold][0] != version:
            self.drop(gold)
            df = tables.scan_table(self.spark, path).withColumn("_versao", F.lit(version))
            self.held[gold] = (version, df.persist(StorageLevel.MEMORY_AND_DISK))
        return self.held[gold][1]

    def ask(self, choice: str, product: int | str | None = None, **filters) -> DataFrame:
        spec = _spec(choice, product)
        return report_series(self.table(spec.gold), spec, product=product, **filters)

    def drop(self, gold: str) -> None:
        if gold in self.held:
            self.held.pop(gold)[1].unpersist()

    def close(self) -> None:
        for gold in list(self.held):
            self.drop(gold)


# --- choice lists and bounds of stored gold tables --------------------------------------


def stored_dates(spark: SparkSession, lake: Lake, gold: str) -> DataFrame:
    """The dates of a stored gold table in order, from its folders: no data file is opened."""
    spec = GOLDS[gold]
    days = sorted(d for d in tables.list_partitions(spark, lake.gold(spec), spec.date_column) if d is not None)
    return spark.createDataFrame([(d,) for d in days], f"{spec.date_column} date")


def stored_date_bounds(spark: SparkSession, lake: Lake, gold: str) -> DataFrame:
    """First and last date of a stored gold table (NULLs without rows), from its folders."""
    return stored_dates(spark, lake, gold).agg(F.min("CodigoData").alias("DataInicial"), F.max("CodigoData").alias("DataFinal"))


def stored_choices(spark: SparkSession, lake: Lake, gold: str, col: str) -> DataFrame:
    """Sorted values of one column of a stored gold table; dates come from the folders, other columns from that column alone."""
    if col == GOLDS[gold].date_column:
        return stored_dates(spark, lake, gold)
    return distinct_values(tables.scan_table(spark, lake.gold(gold)), col)


def stored_rows(spark: SparkSession, lake: Lake, golds: Iterable[str]) -> DataFrame:
    """(tabela, linhas, tem_linhas) of stored gold tables: the counts are pushed down into the Parquet footers, no row is read.

    Spark pushes aggregates down in its second-generation file scan only, which a session of its own turns on; the
    caller's settings stay as they are.
    """
    footers = spark.newSession()
    footers.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    out = None
    for gold in golds:
        path = lake.gold(gold)
        schema, col = tables.read_schema(spark, path)
        if tables.list_partitions(spark, path, col):
            count = footers.read.schema(schema).parquet(path).agg(F.count(F.lit(1)).alias("linhas"))
        else:
            count = footers.range(1).select(F.lit(0).cast("bigint").alias("linhas"))
        count = count.select(F.lit(gold).alias("tabela"), "linhas", (F.col("linhas") > 0).alias("tem_linhas"))
        out = count if out is None else out.unionByName(count)
    return out
