"""Types of columns that no contract declares.

The types form a lattice: BOOLEAN, INT, BIGINT, DOUBLE, DATE and TIMESTAMP, all below STRING; INT widens to BIGINT and to DOUBLE. One
aggregate tries each type on each column and counts the texts that it takes; a column gets the first type that takes them
all. Part files and days differ, so a stored column may widen later: readers then see its older files in the wider type, which
Parquet readers do on the fly. What cannot widen is an error, not a cast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: Type and the form that its texts must have (a cast alone takes more: "1" as BOOLEAN, "2025" as DATE), narrowest first.
FORMS = (
    (T.BooleanType(), r"(?i)^(true|false)$"),
    (T.IntegerType(), r"^[+-]?\d+$"),
    (T.LongType(), r"^[+-]?\d+$"),
    (T.DoubleType(), _NUMBER),
    (T.DateType(), r"^\d{4}-\d{2}-\d{2}$"),
    (T.TimestampType(), r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?([+-]\d{2}:\d{2}|Z)?$"),
)
#: Stored type -> types that its files can be read as. (A DOUBLE does not hold every BIGINT.)
WIDER = {
    T.IntegerType(): (T.LongType(), T.DoubleType()),
    T.FloatType(): (T.DoubleType(),),
}


def _text(col: str) -> Column:
    t = F.trim(F.col(f"`{col}`"))
    return F.when(t != "", t)


def inferred_types(df: DataFrame, cols: list[str]) -> dict[str, T.DataType]:
    """The narrowest type for each of the STRING columns ``cols``; blank texts are NULL, a column of NULLs only is STRING."""
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count(_text(c)).alias(f"n{i}"))
        for j, (kind, form) in enumerate(FORMS):
            aggs.append(F.count(F.when(_text(c).rlike(form), _text(c).try_cast(kind))).alias(f"n{i}_{j}"))
    found = df.agg(*aggs).first()
    return {c: next((kind for j, (kind, _) in enumerate(FORMS) if found[f"n{i}"] and found[f"n{i}_{j}"] == found[f"n{i}"]), T.StringType())
            for i, c in enumerate(cols)}


def with_types(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """``df`` with those columns cast (ANSI: a text that does not fit fails the job)."""
    cast = {c: _text(c).cast(kind).alias(c) for c, kind in types.items() if kind != T.StringType()}
    return df.select(*[cast.get(c, F.col(f"`{c}`")) for c in df.columns])


def widened(stored: T.DataType, new: T.DataType, name: str) -> T.DataType:
    """The type that holds both a stored column and new rows of it. Rows of a narrower type are cast on writing; a wider
    one widens the stored column; anything else is an error."""
    if stored == new or stored in WIDER.get(new, ()):
        return stored
    if new in WIDER.get(stored, ()):
        return new
    raise TypeError(f"column {name}: stored as {stored.simpleString()}, new rows are {new.simpleString()}: neither holds the other")
