"""Exact money arithmetic as Spark Column expressions.

Money is summed as DECIMAL so a total never depends on the order in which
partial sums meet after a shuffle; it becomes DOUBLE only in the output column.
All helpers are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeledger.schemas import MONEY

# Room for a sum over any number of amounts.
WIDE_MONEY = T.DecimalType(38, 4)
# What amounts of another type are compared in.
FINE = T.DecimalType(38, 18)


def as_money(df: DataFrame, col: str) -> Column:
    """A column of ``df`` as MONEY. Nothing is rounded: an amount of another type that MONEY cannot hold exactly fails the job."""
    c = F.col(col)
    if any(f.name.lower() == col.lower() and f.dataType == MONEY for f in df.schema.fields):
        return c
    lost = F.raise_error(F.concat(F.lit(f"{col}: more than {MONEY.scale} decimals: "), c.cast("string")))
    # A DOUBLE below what FINE resolves is not zero, though its cast is.
    gone = (c.cast(FINE) != c.cast(MONEY).cast(FINE)) | ((c != 0) & (c.cast(FINE) == 0))
    return F.when(gone, lost.cast(MONEY)).otherwise(c.cast(MONEY))


def money_sum(df: DataFrame, col: str) -> Column:
    """Exact sum of a money column (DECIMAL result, NULL for an all-NULL group)."""
    return F.sum(as_money(df, col))


def rounded_double(amount: Column, places: int) -> Column:
    """round(amount, places) half-up in decimal, then DOUBLE for the output."""
    return F.round(amount, places).cast(T.DoubleType())


def exact_double_sum(col: str | Column, zero_if_empty: bool = False) -> Column:
    """Sum a DOUBLE measure that holds at most 4 decimals, exactly.

    Each value is first brought back to the decimal it stands for, so the sum
    is the same whatever the order of addition across partitions.
    """
    c = F.col(col) if isinstance(col, str) else col
    total = F.sum(c.cast(WIDE_MONEY))
    if zero_if_empty:
        total = F.coalesce(total, F.lit(0).cast(WIDE_MONEY))
    return total.cast(T.DoubleType())


def half_up_ratio(amount_col: str, units_col: str) -> Column:
    """round(amount / units, 2), ties away from zero, as DOUBLE; NULL if units = 0.

    ``amount_col`` is an exact decimal total with at most four decimals, ``units_col`` an integer total.
    The quotient is rounded in whole numbers (A = amount in ten-thousandths), so no intermediate
    rounding can move a tie: cents = (2*|A| + 100*|u|) div (200*|u|).
    """
    a = f"CAST({amount_col} * 10000 AS DECIMAL(34, 0))"
    u = f"CAST({units_col} AS DECIMAL(19, 0))"
    return F.expr(
        f"CASE WHEN {u} = 0 THEN NULL ELSE "
        f"CAST((CASE WHEN ({a} < 0) <> ({u} < 0) THEN -1 ELSE 1 END) * "
        f"((2 * abs({a}) + 100 * abs({u})) div (200 * abs({u}))) AS DOUBLE) / 100 END"
    )
