"""Codes compared as the source databases compare them.

The databases' usual collations take ``ab`` and ``AB `` for the same code, in joins, filters and groups. A collated ledger has a
key column beside each code column, made once (when the tables are staged, if they are), in which equal codes are equal strings.
Joins, criteria and groups use the keys, so that filters still reach the files; reports show codes as they are written.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.sources.ledger import Ledger
from tallyloom.sources.schemas import DESCRIPTIONS, KEY, LEDGER_COLUMNS, YEAR_KEY


@dataclass(frozen=True)
class Collation:
    """What a database ignores when it compares codes. Accents always count."""

    ignore_case: bool = True
    ignore_trailing: bool = True

    def key(self, column: Column) -> Column:
        """The key of a code; two codes are the same where their keys are."""
        column = F.rtrim(column) if self.ignore_trailing else column
        return F.lower(column) if self.ignore_case else column

    def part(self, column: Column) -> Column:
        """The key of a piece of a code, as of a prefix: its blanks count."""
        return F.lower(column) if self.ignore_case else column


# The usual collation of the source databases.
DATABASE = Collation()


def with_keys(df: DataFrame, table: str, collation: Collation) -> DataFrame:
    """``df`` with a key beside each code that is text; a code that is kept as a number has none and needs none."""
    declared = {part.split()[0]: part.split()[1] for part in LEDGER_COLUMNS[table].split(", ")}
    codes = [
        f.name for f in df.schema.fields
        if declared.get(f.name) == "STRING" and f.name not in DESCRIPTIONS and isinstance(f.dataType, T.StringType)
    ]
    keys = {f"{name}{KEY}": collation.key(F.col(name)) for name in codes}
    if YEAR_KEY in df.columns:
        keys[YEAR_KEY] = collation.key(F.col(YEAR_KEY))
    return df.withColumns(keys)


def collate_ledger(ledger: Ledger, collation: Collation = DATABASE) -> Ledger:
    """``ledger`` with keys in every table, so that its reports compare codes under ``collation``."""
    tables = {name: with_keys(df, name, collation) for name, df in ledger.tables().items() if name in LEDGER_COLUMNS}
    return ledger.with_tables(**tables, collation=collation)
