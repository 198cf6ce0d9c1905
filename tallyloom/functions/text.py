"""String expressions over descriptions and packed periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tail_name(description: Column | str, length: int = 7) -> Column:
    """Name kept in the last ``length`` characters of a description, blanks on both ends dropped."""
    column = F.col(description) if isinstance(description, str) else description
    return F.ltrim(F.right(F.rtrim(column), F.lit(length)))


def period_year(period: Column | str) -> Column:
    """Year part of a YYYYMM string."""
    column = F.col(period) if isinstance(period, str) else period
    return F.left(column, F.lit(4))


def period_month(period: Column | str) -> Column:
    """Month part of a YYYYMM string."""
    column = F.col(period) if isinstance(period, str) else period
    return F.right(column, F.lit(2))


def month_number(month: Column | str) -> Column:
    """Month code as a number; NULL, not an error, for a code that is no number."""
    column = F.col(month) if isinstance(month, str) else month
    return column.try_cast("int")
