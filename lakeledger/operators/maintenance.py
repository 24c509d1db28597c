"""Table maintenance as DataFrame -> DataFrame operators.

These give the *contents* a table has after a delete, an append, a replace or
an upsert; ``lakeledger.sources.tables`` applies them to stored tables by
rewriting only the date partitions they touch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.functions.dates import DateLike, date_lit


def on_date(df: DataFrame, date_col: str, day: DateLike) -> DataFrame:
    """Rows of one processing date (a typed literal, so a bad date fails on the
    driver and the predicate reaches the scan as a partition filter)."""
    return df.filter(F.col(date_col) == date_lit(day))


def delete_date(df: DataFrame, date_col: str, day: DateLike) -> DataFrame:
    """Drop the rows of one date. Rows with a NULL date are kept (a SQL DELETE
    with ``col = d`` never matches NULL)."""
    return df.filter(~F.col(date_col).eqNullSafe(date_lit(day)))


def retain_date(df: DataFrame, date_col: str, day: DateLike) -> DataFrame:
    """Drop the rows of every other date; NULL dates are kept, as with
    ``DELETE ... WHERE col != d``."""
    return df.filter(F.col(date_col).isNull() | (F.col(date_col) == date_lit(day)))


def append_rows(target: DataFrame, rows: DataFrame, evolve: bool = True) -> DataFrame:
    """Bag union by column name. With ``evolve`` new columns are added and
    columns missing on either side read as NULL (schema merge on append)."""
    return target.unionByName(rows, allowMissingColumns=evolve)


def replace_date(target: DataFrame, day_rows: DataFrame, date_col: str, day: DateLike) -> DataFrame:
    """Delete the date, then append the day's rows (running it twice with the
    same rows gives the same table)."""
    return append_rows(delete_date(target, date_col, day), day_rows)


def conform(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows in the target's columns and types: extra source columns are
    dropped, missing ones are NULL (an upsert does not evolve the schema)."""
    have = set(source.columns)
    return source.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def source_key_counts(source: DataFrame, key: str) -> DataFrame:
    """One row per source key with its number of rows (``_n``): a partial
    aggregate, so a key repeated a million times leaves each map task as one
    row and the frame joined against the target never holds a hot key."""
    return source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


SPREAD = "_spread"
#: Column of a change set: -1 for a row that leaves, +1 for one that comes.
SIGN = "_sinal"


def co_partitioned(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a second join column derived from the key. A side that an aggregate
    left partitioned on the key alone is then shuffled for the join like a plain one, and
    adaptive execution can split a hot key only where both sides are plain shuffles."""
    return df.withColumn(SPREAD, F.pmod(F.xxhash64(key), F.lit(1 << 20)))


def with_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``keys`` (one row per key)."""
    return co_partitioned(rows, key).join(co_partitioned(keys, key), [key, SPREAD], "left_semi").select(*rows.columns)


def without_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among ``keys`` (one row per key); NULL keys match nothing and stay."""
    left = co_partitioned(rows.filter(F.col(key).isNotNull()), key).join(co_partitioned(keys, key), [key, SPREAD], "left_anti")
    return left.select(*rows.columns).unionByName(rows.filter(F.col(key).isNull()))


def update_matched(target: DataFrame, src: DataFrame, key: str) -> DataFrame:
    """Target rows, those whose key is in ``src`` with the source's values in all columns. A
    matched key that occurs twice in the source is an error, raised inside the task that meets it."""
    others = [c for c in target.columns if c != key]
    # One row per source key: partial aggregates, so a hot source key leaves each task as one row.
    new = src.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(F.lit(1).alias("_one"), *others)).alias("_new"))
    joined = co_partitioned(target.filter(F.col(key).isNotNull()), key).join(co_partitioned(new, key), [key, SPREAD], "left")
    # The check reads the count (source side) and the key (target side), so
    # it can be neither pushed below the join nor evaluated on unmatched keys.
    fail = F.when(F.col("_n") > 1, F.raise_error(F.concat(
        F.lit("upsert: source key matched more than once: "), F.col(key).cast("string"))))
    current = joined.filter(fail.isNull()).select(*[
        F.col(c) if c == key else F.when(F.col("_n").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        for c in target.columns
    ])
    return current.unionByName(target.filter(F.col(key).isNull()))


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Update every column where the key matches, insert the rest (a MERGE
    with "update all when matched, insert all when not matched").

    Every target row whose key occurs in the source takes that source row's
    values (two target rows with one key give two updated rows); source rows
    whose key matches no target row are inserted. NULL keys never match, so
    such rows are inserted and old ones kept; they take no part in the joins. A matched key
    occurring twice in the source is an error.

    Plan: the target is left-joined once with one row per source key, and the
    source rows without a target match are found by an anti-join against the
    target's distinct keys. Both joins have plain shuffles on both sides
    (``co_partitioned``), so a hot key on either is split by AQE.
    """
    src = conform(source, target)
    keys = target.select(key).filter(F.col(key).isNotNull()).distinct()
    return update_matched(target, src, key).unionByName(without_keys(src, keys, key))
