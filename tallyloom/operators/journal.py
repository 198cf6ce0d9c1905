"""Journal: every line together with its voucher header.

Almost every ledger report starts from this join of two large tables. Each report may join on the fly, or a run of
many reports stages the journal once and reads it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.criteria import differs_from, keep, key_name, meets
from tallyloom.functions.text import month_number
from tallyloom.operators.pointer import Versions
from tallyloom.session import sized_shuffles
from tallyloom.sources.ledger import Ledger
from tallyloom.sources.schemas import KEY, VOUCHER_KEY, YEAR_KEY

HEADER_MONTH = "header_mes"


def journal(ledger: Ledger) -> DataFrame:
    """Lines joined to headers on company, year, number and area; lines without a header are dropped.

    Both sides are large, so this is a shuffle join. A voucher with a large part of all lines is split by adaptive
    execution, which is possible because headers are unique per key. Filters and column choice made on the result
    move below the join.
    """
    if ledger.journal is not None:
        return ledger.journal
    keys = voucher_keys(ledger)
    return joined(ledger.lines, header_columns(ledger, keys), keys)


def voucher_keys(ledger: Ledger) -> list[str]:
    """The columns on which lines meet headers: company, year, number and area, each by its key column where both have one."""
    shared = set(ledger.lines.columns) & set(ledger.headers.columns)
    return [*ledger.scope, *(f"{key}{KEY}" if f"{key}{KEY}" in shared else key for key in VOUCHER_KEY)]


def header_columns(ledger: Ledger, keys: list[str]) -> DataFrame:
    """What the journal takes from the headers."""
    present = ledger.headers.columns
    month = [F.col(f"cpbmes{KEY}").alias(f"{HEADER_MONTH}{KEY}")] if f"cpbmes{KEY}" in present else []
    own = [f"{name}{KEY}" for name in ("cpbtip", "cpbnui", "cpbest") if f"{name}{KEY}" in present]
    return ledger.headers.select(
        *keys, F.col("cpbmes").alias(HEADER_MONTH), "cpbtip", "cpbnui", "cpbest", "cpbfec", *month, *own
    )


def joined(lines: DataFrame, headers: DataFrame, keys: list[str]) -> DataFrame:
    return lines.join(headers, keys).drop(YEAR_KEY)


def narrowed(ledger: Ledger, narrow: Callable[[DataFrame], DataFrame]) -> Ledger:
    """The ledger with its lines cut down before they meet their headers (or in the staged journal)."""
    if ledger.journal is not None:
        return ledger.with_tables(journal=narrow(ledger.journal))
    return ledger.with_tables(lines=narrow(ledger.lines))


def journal_lines(ledger: Ledger, *, posted_only: bool = False, **criteria) -> DataFrame:
    """Journal rows that meet the criteria, given per column (``pctcod=...``, ``cccod=...``)."""
    rows = journal(ledger)
    if posted_only:
        rows = rows.where(meets(rows, "cpbest", ledger.posted_state, ledger.collation))
    return keep(rows, ledger.collation, **criteria)


def without_opening(rows: DataFrame, ledger: Ledger, column: str = "cpbmes") -> DataFrame:
    """Rows outside the opening month, by the line's month or by the header's (``HEADER_MONTH``)."""
    return rows.where(meets(rows, column, differs_from(ledger.opening_month), ledger.collation))


def with_numbered_month(rows: DataFrame) -> DataFrame:
    """Rows whose month code is a number other than zero."""
    return rows.where(month_number("cpbmes") != 0)


def stage_journal(ledger: Ledger, path: str) -> Ledger:
    """Write the journal once, by company and year, and return a ledger whose reports read it.

    A run of many reports then pays for the line-header join once, and each report's filters reach the scan.
    Rebalancing keeps files even when one company or year holds most lines. Inside a file lines are sorted by account
    and centre, by which nearly every report filters, so that a scan skips most of it. A run that fails leaves the
    journal before it as it was, also for those who are reading it.
    """
    partitions = [*ledger.scope, "cpbano"]
    versions = Versions(ledger.lines.sparkSession, path)
    folder = versions.new()
    rows = journal(ledger.with_tables(journal=None))
    with sized_shuffles(rows):
        (
            rows.hint("rebalance", *partitions)
            .sortWithinPartitions(*partitions, key_name(rows, "pctcod"), key_name(rows, "cccod"))
            .write.partitionBy(*partitions)
            .parquet(folder)
        )
    versions.switch(folder)
    # The declared schema keeps company codes such as '001' from being read back as numbers.
    return ledger.with_tables(journal=ledger.lines.sparkSession.read.schema(rows.schema).parquet(folder))


def staged_journal(ledger: Ledger, path: str) -> Ledger:
    """``ledger`` with the journal that was last staged at ``path``."""
    folder = Versions(ledger.lines.sparkSession, path).current()
    if folder is None:
        raise LookupError(f"no journal has been staged at {path}")
    schema = journal(ledger.with_tables(journal=None)).schema
    return ledger.with_tables(journal=ledger.lines.sparkSession.read.schema(schema).parquet(folder))
