"""Date predicates written as ranges, so that they reach the file scan."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def wall_clock(moment: datetime | str) -> Column:
    """Timestamp literal without a time zone.

    A plain Python datetime becomes a zoned literal, and comparing it casts the column and stops the pushdown.
    """
    text = moment if isinstance(moment, str) else moment.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text).cast("timestamp_ntz")


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def since_year(column: Column | str, year: int) -> Column:
    """``year(column) >= year``."""
    column = F.col(column) if isinstance(column, str) else column
    return column >= F.lit(date(year, 1, 1))


def in_year(column: Column | str, year: int | None = None) -> Column:
    """``year(column) = year``, the current year by default."""
    column = F.col(column) if isinstance(column, str) else column
    year = date.today().year if year is None else int(year)
    return (column >= F.lit(date(year, 1, 1))) & (column < F.lit(date(year + 1, 1, 1)))


def year_of(column: Column | str) -> Column:
    return F.year(column).cast("int")


def month_of(column: Column | str) -> Column:
    return F.month(column).cast("int")
