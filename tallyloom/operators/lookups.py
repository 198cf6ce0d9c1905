"""Joins of journal or document rows to dimension tables.

No broadcast is forced. The planner broadcasts a dimension whose size it knows to be below its threshold, adaptive
execution does so for one measured small at run time, and a larger one is joined by shuffling, with hot codes split.
Inner joins drop rows whose code is NULL or unknown, which is part of each report's result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.criteria import key_name
from tallyloom.sources.ledger import Ledger
from tallyloom.sources.schemas import KEY


def look_up(
    rows: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str] | None = None,
    *,
    scope: Sequence[str] = (),
    how: str = "inner",
) -> DataFrame:
    """Join ``rows.key = dimension.key`` for each pair of ``on`` and add the columns of ``take`` (name to new name).

    Where both have a key column for a code (see ``sources.collation``), that is joined on.

    Scope columns join as well where the dimension has them; a dimension without them is shared by all companies.
    """
    shared = [name for name in scope if name in dimension.columns]
    keyed = {
        f"{row_key}{KEY}" if f"{row_key}{KEY}" in rows.columns and f"{key}{KEY}" in dimension.columns else row_key: key
        for row_key, key in on.items()
    }
    picked = dimension.select(
        *shared,
        *[F.col(key_name(dimension, key) if row_key not in on else key).alias(row_key) for row_key, key in keyed.items()],
        *[F.col(name).alias(new) for name, new in (take or {}).items()],
    )
    return rows.join(picked, [*shared, *keyed], how)


def by_codes(rows: DataFrame, *names: str) -> tuple[list[str], list[Column]]:
    """Columns to group ``rows`` by, and what to add to the sums so that each code is shown: in a collated ledger codes are
    grouped by their keys, and the least spelling stands for the group."""
    keys = {name: key_name(rows, name) for name in names}
    return [*keys.values()], [F.min(name).alias(name) for name, key in keys.items() if key != name]


def with_center(rows: DataFrame, ledger: Ledger, name: str = "descripcioncc") -> DataFrame:
    return look_up(rows, ledger.centers, {"cccod": "codicc"}, {"desccc": name}, scope=ledger.scope)


def with_detail(rows: DataFrame, ledger: Ledger, name: str = "descripciondetalle") -> DataFrame:
    return look_up(rows, ledger.details, {"dgacod": "coddet"}, {"desdet": name}, scope=ledger.scope)


def with_account(rows: DataFrame, ledger: Ledger, name: str = "pcdesc") -> DataFrame:
    return look_up(rows, ledger.accounts, {"pctcod": "pccodi"}, {"pcdesc": name}, scope=ledger.scope)


def with_doc_type(rows: DataFrame, ledger: Ledger) -> DataFrame:
    return look_up(rows, ledger.doc_types, {"ttdcod": "coddoc"}, {"desdoc": "desdoc"}, scope=ledger.scope)


def with_counterparty(rows: DataFrame, ledger: Ledger) -> DataFrame:
    return look_up(rows, ledger.counterparties, {"codaux": "codaux"}, {"nomaux": "nomaux"}, scope=ledger.scope)
