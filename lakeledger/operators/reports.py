"""Report questions over a gold table, answered in Spark.

A report filters a gold table by branches, an optional product and a date
range, then sums one measure per date and branch. Filters are plain column
predicates, so on a stored gold table (partitioned by date) the date range
prunes partitions and the branch/product predicates reach the Parquet scan.
Only the aggregated series -- at most dates x chosen branches rows -- is ever
meant to leave the cluster.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.functions.dates import DateLike, as_date
from lakeledger.functions.money import exact_double_sum

ALL_PRODUCTS = "*"


@dataclass(frozen=True)
class ReportSpec:
    gold: str
    measure: str
    exact_decimal: bool  # DOUBLE money measure, summed exactly in decimal
    has_product: bool = False


# The three report choices and the measure each one charts.
REPORTS = {
    "impostos": ReportSpec("impostos", "TotalImpostoPago", exact_decimal=True),
    "fretes": ReportSpec("fretes", "TotalFretePago", exact_decimal=True),
    "produtos": ReportSpec("produtos", "TotalQuantidadeVendida", exact_decimal=False,
                           has_product=True),
}


def filter_gold(
    df: DataFrame,
    branches: Iterable[str],
    date_from: DateLike | None = None,
    date_to: DateLike | None = None,
    product: int | str | None = None,
) -> DataFrame:
    """Rows of chosen branches, inside [date_from, date_to], of one product or all.

    No branch chosen means no rows (not "all branches"). ``product`` of None or
    "*" means every product.
    """
    out = df.filter(F.col("FilialId").isin(list(branches)))
    if date_from is not None:
        out = out.filter(F.col("CodigoData") >= F.lit(as_date(date_from)))
    if date_to is not None:
        out = out.filter(F.col("CodigoData") <= F.lit(as_date(date_to)))
    if product is not None and product != ALL_PRODUCTS:
        out = out.filter(F.col("ProdutoId") == F.lit(int(product)))
    return out


def report_detail(df: DataFrame, keys: list[str], **filters) -> DataFrame:
    """The filtered gold rows, all columns, in key order."""
    return filter_gold(df, **filters).orderBy(*keys)


def report_series(df: DataFrame, spec: ReportSpec, **filters) -> DataFrame:
    """One measure summed per date and branch, in (date, branch) order.

    An all-NULL group sums to 0, as a chart of the series would show it.
    """
    return _series(filter_gold(df, **filters), spec).orderBy("CodigoData", "FilialId")


def _series(rows: DataFrame, spec: ReportSpec) -> DataFrame:
    m = spec.measure
    if spec.exact_decimal:
        total = exact_double_sum(m, zero_if_empty=True)
    else:
        total = F.coalesce(F.sum(m), F.lit(0).cast("bigint"))
    return rows.groupBy("CodigoData", "FilialId").agg(total.alias(m))


def chosen_series(df: DataFrame, spec: ReportSpec, branches: DataFrame, dates: DataFrame) -> DataFrame:
    """The series of the branches (column FilialId) and dates (column CodigoData) that two tables list, however long the lists are.

    Both are semi-joins, so a choice that stands twice counts once and a NULL chooses nothing. Where a list is small enough to broadcast (the
    planner's check), its dates prune the folders of a stored gold table when the query runs.
    """
    # A comparison on the list is what makes the planner prune dynamically; it holds for every date.
    days = dates.select("CodigoData").filter(F.col("CodigoData") >= F.expr("DATE'0001-01-01'")).distinct()
    chosen = df.join(days, "CodigoData", "left_semi").join(branches.select("FilialId").distinct(), "FilialId", "left_semi")
    return _series(chosen, spec).orderBy("CodigoData", "FilialId")


def detail_pages(df: DataFrame, keys: list[str], rows: int, **filters) -> Iterator[DataFrame]:
    """The filtered gold rows in key order, ``rows`` at a time. ``keys`` identify a row.

    A page begins behind the last key of the one before: a predicate, not an offset, so no page reads what the earlier
    ones showed, and on a stored table its first key prunes folders and row groups. Only that one key reaches the driver.
    """
    chosen = filter_gold(df, **filters)
    at: tuple | None = None
    while True:
        page = (chosen if at is None else chosen.filter(_behind(keys, at))).orderBy(*keys).limit(rows)
        n, last = page.agg(F.count("*"), F.max(F.struct(*keys))).first()
        if n:
            yield page
        if n < rows:
            return
        at = tuple(last)


def _behind(keys: list[str], at: tuple):
    """Rows after the key ``at`` in key order (NULL first)."""
    out = F.lit(False)
    for k, v in reversed(list(zip(keys, at))):
        more = F.col(k).isNotNull() if v is None else F.col(k) > F.lit(v)
        out = more | (F.col(k).eqNullSafe(F.lit(v)) & out)
    first = F.col(keys[0])
    # Implied by the rest, but a form that reaches the scan.
    return out if at[0] is None else (first >= F.lit(at[0])) & out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-NULL values of one column (a choice list)."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def date_bounds(df: DataFrame) -> DataFrame:
    """First and last date of a gold table (the default range)."""
    return df.agg(F.min("CodigoData").alias("DataInicial"), F.max("CodigoData").alias("DataFinal"))


def default_branch(df: DataFrame) -> DataFrame:
    """The first branch in sort order (the default choice)."""
    return df.agg(F.min("FilialId").alias("FilialId"))


def has_rows(df: DataFrame) -> bool:
    """Whether a table holds any row; reads at most one row."""
    return not df.isEmpty()


def collect_series(series: DataFrame, max_rows: int):
    """An aggregated report as a pandas frame, for a chart or a table.

    Only the aggregated series (at most dates x chosen branches rows) is meant
    to reach the driver. The caller states how many rows it takes (``max_rows``); one more is transferred at
    most, and a larger result is refused instead of being cut. Larger reports stay DataFrames.
    """
    out = series.limit(max_rows + 1).toPandas()
    if len(out) > max_rows:
        raise ValueError(f"report has more than {max_rows} rows; aggregate or filter it first")
    return out


@contextmanager
def report_batch(gold: DataFrame) -> Iterator[DataFrame]:
    """Re-use one gold table across a group of report questions.

    The table is persisted on the executors (memory, spilling to disk; a lost
    block is recomputed from the plan) for the duration of the block and
    released afterwards. Gold tables are aggregates, bounded by dates x
    products x branches, so they fit the cache at any input size.
    """
    cached = gold.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield cached
    finally:
        cached.unpersist()
