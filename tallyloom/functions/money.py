"""Money columns: exact decimals while summing, DOUBLE in the finished report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(column: Column | str) -> Column:
    """Exact amount. Sums of doubles depend on the order of addition, so no report sums doubles."""
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def net_debit() -> Column:
    """Debit minus credit of a journal line."""
    return money("movdebe") - money("movhaber")


def net_credit() -> Column:
    """Credit minus debit, the sign used for income."""
    return money("movhaber") - money("movdebe")


def shown(amount: Column) -> Column:
    """An amount as reports give it out."""
    return amount.cast("double")


def total(amount: Column) -> Column:
    """Sum of an amount, NULL for a group without any amount."""
    return F.sum(amount)


def without_vat(amount: Column, factor: float) -> Column:
    """Amount before tax, for a tax factor such as 1.19."""
    return shown(amount) / F.lit(float(factor))
