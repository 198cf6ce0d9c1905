"""Sorted report output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_first(df: DataFrame, *columns: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Sort by ``columns`` descending.

    ``ties`` are sorted ascending behind them, then a hash of the whole row. They make the order repeatable and let the
    range partitioning split a date or voucher that holds a large part of all rows. Rows that are equal throughout,
    whose order shows nowhere, are told apart by their number, so that these are split as well.
    """
    numbered = df.withColumn("__row", F.monotonically_increasing_id())
    ordered = numbered.orderBy(
        *[F.col(c).desc() for c in columns], *[F.col(c).asc() for c in ties], F.xxhash64(*df.columns), "__row"
    )
    return ordered.drop("__row")
