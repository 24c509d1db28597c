"""Processing-date handling on the driver (argument parsing, file names)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = dt.date | str


def as_date(value: DateLike) -> dt.date:
    """Parse a processing date; a bad value fails here, on the driver."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value).strip())


def file_token(value: DateLike) -> str:
    """Date as it appears in a daily file name: 2025-09-19 -> 2025_09_19."""
    return as_date(value).strftime("%Y_%m_%d")


def date_lit(value: DateLike) -> Column:
    """A typed DATE literal, so comparisons never go through string casts."""
    return F.lit(as_date(value))


def sorted_dates(values: Iterable[DateLike]) -> list[dt.date]:
    return sorted({as_date(v) for v in values})
